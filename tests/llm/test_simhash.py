import re

import numpy as np
import pytest
import xxhash

from ledgerlake.llm.components import components
from ledgerlake.llm.simhash import MAX_BITS, fingerprint, keep_one, links, near_duplicates

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] if len(words) >= 4 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """{node: smallest node reachable} over all pairs of at most MAX_BITS differing bits."""
    nodes = sorted(prints)
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    values = np.array([prints[n] for n in nodes], np.uint64)
    for i, n in enumerate(nodes):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= MAX_BITS):
            a, b = find(n), find(nodes[i + 1 + j])
            root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("text", ["", " \t\n", "One", "one two\x0bthree", "A b c d e f g", "x " * 3000, "É é E e É é"])
def test_fingerprint_matches_brute_force(text):
    assert fingerprint(text.encode()) == brute_print(text)


def test_whole_corpus_matches_brute_force(corpus, texts):
    got = {r.doc_id: (r.fp % 2**64, r.component_id) for r in near_duplicates(corpus).collect()}
    prints = {i: brute_print(t) for i, t in texts.items()}
    comp = brute_components(prints)
    assert got == {i: (prints[i], comp[i]) for i in texts}
    kept = keep_one(corpus)
    assert kept.columns == corpus.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(comp.values()))


@pytest.mark.parametrize("hot", [10**6, 5])
def test_links_connect_dense_and_sparse_prints(spark, hot):
    """Balls of near prints, chains of single steps and random prints; ``hot`` 5 splits most buckets."""
    rng = np.random.default_rng(3)
    prints = set(rng.integers(0, 2**64, 200, np.uint64).tolist())
    for centre in rng.integers(0, 2**64, 3, np.uint64).tolist():
        for _ in range(150):
            flips = sum({1 << int(b): 0 for b in rng.integers(0, 64, rng.integers(0, 6))})
            prints.add(centre ^ flips)
        walk = centre
        for _ in range(30):
            for b in rng.choice(64, 4, replace=False):
                walk ^= 1 << int(b)
            prints.add(walk)
    signed = [(int(np.uint64(p).view(np.int64)),) for p in prints]
    found = links(spark.createDataFrame(signed, "fp long"), hot)
    rows = found.collect()
    assert all(bin((r.a ^ r.b) % 2**64).count("1") <= MAX_BITS for r in rows)
    got = {p: p for (p,) in signed} | {r.node: r.root for r in components(found).collect()}
    assert got == brute_components({p: p % 2**64 for (p,) in signed})


def test_null_ids_repeats_and_empty_texts(docs_of):
    rows = [(5, None), (4, ""), (None, " "), (7, "a b c d e"), (7, "A B C D E"), (7, "A B C D E"), (None, "only null here at all"), (9, "w " * 50000)]
    docs = docs_of(rows)
    got = near_duplicates(docs).collect()
    assert len(got) == len(rows)
    assert sorted((r.component_id is None, r.component_id or 0) for r in got) == sorted([(False, 4)] * 3 + [(False, 7)] * 3 + [(True, 0), (False, 9)])
    kept = keep_one(docs).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept) == [(False, 4), (False, 7), (False, 9), (True, 0)]


def test_empty_table(docs_of):
    assert near_duplicates(docs_of([])).collect() == [] and keep_one(docs_of([])).collect() == []
