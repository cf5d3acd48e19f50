import math
import zlib

import numpy as np

from ledgerlake.llm import quality as Q
from ledgerlake.llm.quality import FEATURES, features, fit, good, scored

SF = "/root/testdata/sf0.001"


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = {r.doc_id: r for r in scored(docs, labels).collect()}
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for i, r in got.items())
    held = [(got[r.doc_id].predicted, r.quality) for r in labels.collect() if got[r.doc_id].held_out]
    assert np.mean([p == q for p, q in held]) >= 0.97
    kept = {r.doc_id for r in good(docs, labels).collect()}
    assert kept == {i for i, r in got.items() if r.predicted}


def test_pairs_learn_what_single_features_cannot():
    rng = np.random.default_rng(0)
    rows = rng.random((3000, len(FEATURES)))
    y = ((rows[:, 2] > 0.5) ^ (rows[:, 5] > 0.5)).astype(float)
    model = fit(rows, y)
    assert (2, 5) in model.pairs
    assert np.mean((model.score(rows) > 0.5) == y) > 0.95


def test_edges(spark, docs_of):
    docs = docs_of([(1, None), (2, ""), (3, "good words here."), (3, "good words here."), (None, "x"), (4, "z" * 200000)])
    none = scored(docs, labels_of(spark, [])).collect()
    assert len(none) == 6 and {r.score for r in none} == {0.5}
    one_kind = scored(docs, labels_of(spark, [(3, 1, 0), (3, 1, 0), (1, None, 0), (None, 1, 0)])).collect()
    assert len({r.score for r in one_kind}) == 1 and one_kind[0].score > 0.5
    both = scored(docs, labels_of(spark, [(3, 1, 0), (4, 0, 0), (2, 0, 1)])).collect()
    assert len(both) == 6 and all(0 <= r.score <= 1 for r in both)
    assert scored(docs_of([]), labels_of(spark, [(3, 1, 0)])).collect() == []
    assert features(b"") == features(b" \n") == [0.0] * len(FEATURES)


def plain_features(text):
    """The features in plain Python, from the text's bytes."""
    data = text.encode()
    words = data.split()
    if not words:
        return [0.0] * len(Q.FEATURES)
    n, signs = len(words), max(1, sum(b != 32 for b in data))
    lines = [x for x in data.split(b"\n") if x.strip()]
    within = lambda lo, hi: sum(lo <= b <= hi for b in data)
    upper, lower = within(65, 90), within(97, 122)
    times = {w: words.count(w) for w in set(words)}
    return [
        math.log1p(n), signs / n, len(times) / n, math.log1p(len(lines)), len(set(lines)) / max(1, len(lines)), upper / max(1, upper + lower),
        within(48, 57) / signs, sum(chr(b) in "#$%&*@^~_=+<>/\\{}[]" for b in data) / signs, data.count(b"|") / n, data.count(b"!") / n,
        (data.count(b",") + data.count(b".")) / n, within(128, 255) / signs, sum(chr(w[-1]) in "#$%&*!|" and len(w) > 1 for w in words) / n,
        sum(len(w) == 1 and not w.isalnum() for w in words) / n, sum(65 <= w[0] <= 90 for w in words) / n, max(times.values()) / n,
        math.log1p(len(data) / max(1, len(lines))), math.log1p(max(map(len, words))),
    ]


def test_features_and_scores_match_brute_force_on_the_corpus(spark, corpus, texts):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = Q.train(corpus, labels)
    got = {r.doc_id: r.score for r in Q.scored(corpus, labels).collect()}
    assert got.keys() == texts.keys()
    for doc_id, text in texts.items():
        x = plain_features(text) if len(text) < 20000 else Q.features(text.encode())
        assert np.allclose(x, Q.features(text.encode()))
        bins = [sum(v >= edge for edge in edges) for v, edges in zip(x, model.edges)]
        total = model.intercept + sum(t[b] for t, b in zip(model.tables, bins))
        total += sum(t[bins[f], bins[g]] for (f, g), t in zip(model.pairs, model.pair_tables))
        assert math.isclose(got[doc_id], 1 / (1 + math.exp(-total)), abs_tol=1e-9)


def test_cuts_match_an_exhaustive_search():
    rng = np.random.default_rng(3)
    gain = lambda g, h: g * g / (h + Q.RIDGE)
    for _ in range(50):
        n, m = rng.integers(2, 7, 2)
        g, h = rng.normal(size=n) * 5, rng.uniform(0.5, 4, n)
        cuts = {a: gain(g[:a].sum(), h[:a].sum()) + gain(g[a:].sum(), h[a:].sum()) - gain(g.sum(), h.sum())
                for a in range(1, n) if h[:a].sum() >= Q.LEAF and h[a:].sum() >= Q.LEAF}
        best, at = Q._split(g, h)
        if cuts and max(cuts.values()) > 1e-9:
            assert at == max(cuts, key=cuts.get) and math.isclose(best, cuts[at], rel_tol=1e-9)
        else:
            assert at == 0
        g2, h2 = rng.normal(size=(n, m)) * 5, rng.uniform(0.5, 4, (n, m))
        quads = {}
        for a in range(1, n):
            for b in range(1, m):
                parts = [(slice(*r), slice(*c)) for r in ((0, a), (a, n)) for c in ((0, b), (b, m))]
                quads[a, b] = sum(gain(g2[p].sum(), h2[p].sum()) for p in parts) - gain(g2.sum(), h2.sum())
        best, values = Q._pair_tree(g2, h2)
        a, b = max(quads, key=quads.get)
        assert math.isclose(best, quads[a, b], rel_tol=1e-9)
        assert math.isclose(values[0, 0], -g2[:a, :b].sum() / (h2[:a, :b].sum() + Q.RIDGE)) and math.isclose(values[-1, -1], -g2[a:, b:].sum() / (h2[a:, b:].sum() + Q.RIDGE))
