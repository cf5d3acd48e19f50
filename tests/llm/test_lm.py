import math
import re
import zlib
from collections import Counter

import numpy as np

from ledgerlake.llm import lm
from ledgerlake.llm.attention import BLOCK, GROUPS, MEMBERS, Attention, Sums, _add_rows, block_sums, log_chances, rows_of, unpack

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), None]


def test_base_scores_match_brute_force_and_the_model_beats_its_start(spark, docs_of, monkeypatch):
    monkeypatch.setattr(lm, "HEAD_WORDS", 500)  # so that many words are looked up by the join
    corpus = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("n_chars < 3000")
    rows = [(r.doc_id, r.text) for r in corpus.collect()] + [(10**7, None), (10**7 + 1, ""), (10**7 + 2, "the"), (10**7 + 2, "the"), (None, "of the")]
    got = lm.score(docs_of(rows)).collect()
    assert len(got) == len(rows)
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    count = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v = sum(count.values()), len(count)
    texts = {}
    for i, t in rows:
        texts[i] = tokens(t)
    for r in got:
        own = texts[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(r.doc_id), len(own), sum(count[w] > 0 for w in own), n)
        assert math.isclose(r.base_score, sum(math.log10((count[w] + 1) / (n + v + 1)) for w in own), rel_tol=1e-9)
        assert r.score < 0
    proto = open(lm.TOKENIZER, "rb").read()
    untrained = Attention(lm.subword_counts(lm.word_counts(docs_of(rows)), proto)).tables()
    lexicon = lm.Lexicon(proto, [], np.zeros(0))
    unseen = [(r.score, " ".join(w for w in texts[r.doc_id] if w).encode()) for r in got if r.held_out]
    start = sum(s[3] for s in lm._score(lexicon, untrained, [t for _, t in unseen]))
    assert sum(s for s, _ in unseen) > 0.97 * start  # log10: closer to zero is better


def test_gradients():
    rng = np.random.default_rng(0)
    model = Attention(rng.integers(0, 50, 40).astype(float))
    ids, target = rng.integers(0, 40, (3, 2 * BLOCK)), rng.integers(-1, 40, (3, 2 * BLOCK))
    _, grads = model.loss(ids, target)
    for name, values in model.p.items():
        at = (ids[0, 3], 2) if name == "e" else tuple(rng.integers(0, s) for s in values.shape)
        old, values[at] = values[at], values[at] + 1e-5
        up = model.loss(ids, target)[0]
        values[at] = old - 1e-5
        down = model.loss(ids, target)[0]
        values[at] = old
        assert math.isclose((up - down) / 2e-5, grads[name][at], rel_tol=1e-3, abs_tol=1e-9)


def test_windows_score_each_token_once_from_the_right_context():
    rng = np.random.default_rng(1)
    model = Attention(rng.integers(0, 50, 300).astype(float))
    x, y = rng.integers(0, 300, 3 * BLOCK + 3), rng.integers(0, 300, 3 * BLOCK + 3)
    rows, target, first, _ = rows_of([(x[:5], y[:5]), (x, y)])
    got = model.tables().log10(rows, target, first)
    assert (got != 0).sum() == 5 + len(x)
    got = got[1:].ravel()[: len(x)]
    p = model.p
    for j in range(len(x)):
        around = x[max(0, j // BLOCK * BLOCK - BLOCK) : j + 1]
        e = p["e"][around]
        a = (e @ p["k"]) @ (e[-1] @ p["q"]) / 4 + p["d"][np.arange(len(around))[::-1]]
        w = np.exp(a - a.max())
        h = e[-1] + w / w.sum() @ (e @ p["v"])
        soft = lambda z: np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        within = np.concatenate([soft(z) for z in np.split(h @ p["c"] + p["b"], GROUPS)])
        chance = np.repeat(soft(h @ p["g"] + p["gb"]), MEMBERS) * within
        assert math.isclose(got[j], math.log10(chance[model.of[y[j]]]) + model.share[y[j]], abs_tol=1e-4)


def test_chances_add_up_to_one():
    model = Attention(np.random.default_rng(2).integers(0, 50, 200).astype(float))
    rows, target, first, _ = rows_of([(np.array([1]), np.array([n])) for n in range(200)])
    assert math.isclose((10 ** model.tables().log10(rows, target, first)[:, 0]).sum(), 1, rel_tol=1e-4)


def test_large_weights_give_finite_scores():
    """Scores far beyond the range of exp: each row's maximum is taken off."""
    rng = np.random.default_rng(8)
    model = Attention(rng.integers(0, 50, 300).astype(float))
    for name, scale in (("e", 30), ("q", 10), ("k", 10), ("c", 20), ("g", 50), ("d", 0)):
        model.p[name] = model.p[name] * scale
    model.p["d"] = rng.normal(0, 300, 2 * BLOCK)
    ids, target, first = rng.integers(0, 300, (40, BLOCK)), rng.integers(0, 300, (40, BLOCK)), rng.random(40) < 0.2
    first[0] = True
    got = model.tables().log10(ids, target, first)
    assert np.isfinite(got).all() and (got <= 1e-6).all() and got.min() < -10
    sums = block_sums({k: v.astype(np.float32) for k, v in model.p.items()}, model.of, ids, target, first)
    assert np.isfinite(sums).all() and math.isclose(sums[-1, 0], -(got - model.share[target]).sum() * math.log(10), rel_tol=1e-3)


def test_pieces_of_a_long_text_count_the_same(monkeypatch):
    proto = open(lm.TOKENIZER, "rb").read()
    tables = Attention(np.ones(32000)).tables()
    text = b" ".join(b"word%d" % (i % 50) for i in range(1000))
    whole = lm._score(lm.Lexicon(proto, [b"word1"], np.array([2.0])), tables, [text, b""])
    monkeypatch.setattr(lm, "GROUP_WORDS", 90)
    parts = lm._score(lm.Lexicon(proto, [b"word1"], np.array([2.0])), tables, [text, b""])
    assert whole[0][:3] == parts[0][:3] == (1001, 20, 40.0) and whole[0][4] == parts[0][4]
    assert whole[1][0] == 1 and math.isclose(whole[0][3], parts[0][3], rel_tol=0.01)


def test_empty_table(docs_of):
    assert lm.score(docs_of([])).collect() == []


def test_head_words_are_the_most_frequent_that_fit(spark):
    rows = [(b"", 9000)] + [(b"w%d" % i, n) for i, n in enumerate([5000, 4900, 1000, 7, 7, 7, 3, 1])] + [(b"x" * 65, 400)]
    counts = spark.createDataFrame([(bytearray(w), n) for w, n in rows], "word binary, n long")
    got = lambda most: sorted(r.n for r in lm.head_words(counts, most).collect())
    assert got(100) == [1, 3, 7, 7, 7, 1000, 4900, 5000]
    assert got(6) == [7, 7, 7, 1000, 4900, 5000] and got(5) == [1000, 4900, 5000] and got(1) == []


def test_block_sums_are_gradients_and_loss_of_the_scored_rows():
    rng = np.random.default_rng(3)
    model = Attention(rng.integers(1, 50, 300).astype(float))
    x, y = rng.integers(0, 300, 3 * BLOCK + 3), rng.integers(0, 300, 3 * BLOCK + 3)
    rows, target, first, _ = rows_of([(x[:5], y[:5]), (x, y)])
    value = lambda p: block_sums(p, model.of, rows, target, first)
    got = value(model.p)
    chances = model.tables().log10(rows, target, first)[target >= 0] - model.share[target[target >= 0]]
    assert math.isclose(got[-1, 0], -chances.sum() * math.log(10), rel_tol=1e-4) and got[-1, 1] == 5 + len(x)
    grads = unpack(got[:-1], model.p)
    for name, values in model.p.items():
        at = (x[BLOCK + 1], 2) if name == "e" else tuple(rng.integers(0, s) for s in values.shape)
        old, values[at] = values[at], values[at] + 1e-5
        up = value(model.p)[-1, 0]
        values[at] = old - 1e-5
        down = value(model.p)[-1, 0]
        values[at] = old
        assert math.isclose((up - down) / 2e-5, grads[name][at], rel_tol=1e-3, abs_tol=1e-6)


def test_every_subword_of_the_training_documents_is_trained_on_once(spark, docs_of, monkeypatch):
    monkeypatch.setattr(lm, "GROUP_WORDS", 700)
    monkeypatch.setattr(lm, "PIECE", 4 * BLOCK)
    proto = open(lm.TOKENIZER, "rb").read()
    rows = [(i, " ".join(f"word{i * j % 91}" for j in range(n))) for i, n in enumerate([1, 3000, 40, 64, 0, 700, 701])] + [(None, "x"), (5, "again")]
    docs = docs_of(rows)
    pieces = lm.training_pieces(docs, proto, 1000, 3).collect()
    target = Counter(t for r in pieces for t in r.ids[r.context + 1 :])
    counts = lm.subword_counts(lm.word_counts(docs), proto)
    assert {i: n for i, n in enumerate(counts.tolist()) if n} == target and {r.step for r in pieces} == {0, 1, 2}
    assert all(r.context in (0, BLOCK) and (r.context or r.ids[0] == lm.BEGIN) for r in pieces)


def test_words_outside_the_sampled_windows_are_learned(spark, docs_of, monkeypatch):
    """The sample is one text of one kind; the other kinds' word pairs are learned from the whole corpus."""
    windows = lm.training_windows
    monkeypatch.setattr(lm, "training_windows", lambda docs, proto: windows(docs, proto, 1))
    train = [i for i in range(1000) if zlib.crc32(str(i).encode()) % 7 != 2]
    pairs = ("sun moon ", "red blue ", "cat dog ", "tea milk ")
    docs = docs_of([(i, pairs[n % 4] * 300) for n, i in enumerate(train[:80])])
    got = lm.score(docs).selectExpr("score / n_tokens AS each").collect()
    assert sum(r.each for r in got) / len(got) > -0.6


def test_sums_of_several_calls_add_up_whatever_the_chunks(monkeypatch):
    rng = np.random.default_rng(5)
    model = Attention(rng.integers(1, 50, 300).astype(float))
    texts = [(rng.integers(0, 300, n), rng.integers(-1, 300, n)) for n in (1, 7 * BLOCK + 3, BLOCK, 40, 5 * BLOCK)]
    whole = block_sums(model.p, model.of, *rows_of(texts)[:3])
    monkeypatch.setattr("ledgerlake.llm.attention.GRADIENT_BLOCKS", 3)
    sums = Sums(model.p, model.of)
    for text in texts:
        sums.add(*rows_of([text])[:3])
    assert np.allclose(sums.packed(), whole, rtol=1e-9, atol=1e-9) and whole[-1, 1] == sum((y >= 0).sum() for _, y in texts)


def test_rows_without_a_class_have_no_chance_and_no_gradient():
    rng = np.random.default_rng(6)
    model = Attention(rng.integers(1, 50, 300).astype(float))
    h, want = rng.normal(size=(50, 16)), rng.integers(-1, GROUPS * MEMBERS, 50)
    grads, fewer = ({name: np.zeros(v.shape) for name, v in model.p.items()} for _ in range(2))
    logs, back = log_chances(model.p, h, want, grads)
    own = want >= 0
    logs_, back_ = log_chances(model.p, h[own], want[own], fewer)
    assert np.allclose(logs[own], logs_) and np.allclose(back[own], back_) and not logs[~own].any() and not back[~own].any()
    assert all(np.allclose(grads[name], fewer[name]) for name in grads)


def test_rows_are_added_by_number():
    rng = np.random.default_rng(7)
    for size in (50, 70_000):  # numbers of 16 bits and more
        at, rows = rng.integers(0, size, 400), rng.normal(size=(400, 3))
        got, expected = np.ones((size, 3)), np.ones((size, 3))
        _add_rows(got, at, rows)
        np.add.at(expected, at, rows)
        assert np.allclose(got, expected)
    _add_rows(got, at[:0], rows[:0])
    assert np.allclose(got, expected)


def test_other_words_are_listed_per_text():
    counts = [Counter({b"a": 2, b"b": 1}), Counter(), Counter({b"a": 3})]
    pairs = [[(p["word"], p["n"]) for p in own] for own in lm._listed(counts).to_pylist()]
    assert pairs == [[(b"a", 2), (b"b", 1)], [], [(b"a", 3)]] and lm._listed([]).to_pylist() == []
