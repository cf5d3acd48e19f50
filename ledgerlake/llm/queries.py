"""Registered queries of this subpackage and their DuckDB statements."""

from __future__ import annotations

from ledgerlake.llm import clustering, conversations, decontaminate, exact_dedup, html_text, licenses, lm, mixing, pii, quality, sharding, simhash, token_files

QUERIES = {
    "op1_diagonal_licenses": licenses.op1_diagonal_licenses,
    "op2_consensus_html": html_text.op2_consensus_html,
    "op3_bloom_exact_dedup": exact_dedup.op3_bloom_exact_dedup,
    "op4_pigeonring_simhash": simhash.op4_pigeonring_simhash,
    "op5_weak_supervision_pii": pii.op5_weak_supervision_pii,
    "op6_attention_scores": lm.op6_attention_scores,
    "op7_hash_tree_shards": sharding.op7_hash_tree_shards,
    "op8_minhash_containment": decontaminate.op8_minhash_containment,
    "op9_source_schedule": mixing.op9_source_schedule,
    "op10_additive_quality": quality.op10_additive_quality,
    "op11_ptolemaic_clusters": clustering.op11_ptolemaic_clusters,
    "op12_prefix_doubling_repair": conversations.op12_prefix_doubling_repair,
    "op13_flat_token_files": token_files.op13_flat_token_files,
}

SQL = {
    "op1_diagonal_licenses": licenses.SQL,
    "op3_bloom_exact_dedup": exact_dedup.SQL,
    "op7_hash_tree_shards": sharding.SQL,
    "op8_minhash_containment": decontaminate.SQL,
    "op9_source_schedule": mixing.SQL,
    "op11_ptolemaic_clusters": clustering.SQL,
    "op12_prefix_doubling_repair": conversations.SQL,
}
