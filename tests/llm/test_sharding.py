import math
import zlib
from hashlib import md5

import pytest

from ledgerlake.llm.sharding import even_tree, grown, shard_documents, with_tree_shard


def brute(doc_id, tree, seed="shard"):
    weigh = lambda n: n if isinstance(n, (int, float)) else sum(map(weigh, n))
    leaves = lambda n: 1 if isinstance(n, (int, float)) else sum(map(leaves, n))
    node, path, first = tree, "", 0
    while not isinstance(node, (int, float)):
        draws = []
        for i, child in enumerate(node):
            bits = int(md5(f"{seed}:{doc_id}:{path}/{i}".encode()).hexdigest()[:13], 16)
            draws.append((-math.log((bits + 0.5) / 2**52) / weigh(child), i))
        i = min(draws)[1]
        first += sum(leaves(c) for c in node[:i])
        node, path = node[i], f"{path}/{i}"
    return first


def test_matches_brute_force_and_grows_into_the_new_shard_only(corpus, texts):
    tree = even_tree()
    got = shard_documents(corpus).collect()
    assert len(got) == len(texts)
    for r in got:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 8, zlib.crc32(data), "key")
        assert r.shard == brute(r.doc_id, tree) and r.grown_shard == brute(r.doc_id, grown(tree))
        assert r.grown_shard in (r.shard, 24)
    for shard in range(24):
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))


def test_weights_move_rows_only_into_the_subtree_that_grew(spark):
    ids = spark.range(3000)
    light, heavy = [[[1.0, 1.0], [2.0]], [[1.0, 3.0]]], [[[1.0, 1.0], [2.0]], [[1.0, 9.0]]]
    rows = with_tree_shard(with_tree_shard(ids, "id", light, "a"), "id", heavy, "b").collect()
    assert all(r.a == r.b or r.b in (3, 4) for r in rows)
    assert any(r.a < 3 <= r.b for r in rows)
    share = sum(r.a == 4 for r in rows) / len(rows)
    assert abs(share - 3 / 8) < 0.04


def test_nulls_repeats_and_empty_table(docs_of):
    got = shard_documents(docs_of([(1, None), (1, None), (None, "é"), (None, ""), (2, "x" * 100000)])).collect()
    assert sorted(r.size for r in got) == [8, 8, 8, 10, 100008]
    assert len({r.shard for r in got if r.doc_id is None}) == 1
    assert sorted(r.slot for r in got if r.doc_id == 1) in ([0, 1], [1, 2], [2, 3], [3, 4])
    assert shard_documents(docs_of([])).collect() == []


def test_a_tree_without_leaves_is_refused(spark):
    with pytest.raises(ValueError):
        with_tree_shard(spark.range(1), "id", [], "s")
