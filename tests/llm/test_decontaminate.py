import re

from pyspark.core.broadcast import Broadcast

from ledgerlake.llm import decontaminate
from ledgerlake.llm.decontaminate import Items, clean, contaminated, need

ITEM = "The quick brown fox jumps over the lazy dog, while seven other dogs sleep in the warm sun."


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub(r"[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, "extra") for i, t in rows], "item_id long, text string, doc_id string")


def test_corpus_matches_brute_force(spark, corpus, texts):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    want = set()
    items = [(r.item_id, shingles(r.text)) for r in bench.collect()]
    for doc_id, text in texts.items():
        have = shingles(text)
        want |= {(doc_id, i, len(s & have), len(s)) for i, s in items if s and len(s & have) >= need(len(s))}
    got = contaminated(corpus, bench)
    assert {(r.doc_id, r.item_id, r.shared, r.item_shingles) for r in got.collect()} == want and want
    left = clean(corpus, bench)
    assert left.columns == corpus.columns
    assert {r.doc_id for r in left.collect()} == set(texts) - {w[0] for w in want}


def test_partial_items_long_documents_and_edges(spark, docs_of):
    w = ITEM.split()
    rows = [
        (1, "filler " * 50000 + ITEM.upper() + " more" * 50000),
        (2, " ".join(w[:-2])),  # 12 of 14 shingles
        (3, " ".join(w[:-4])),  # 10 of 14
        (4, "tiny item"),
        (5, "a tiny item"),
        (6, None),
        (7, ""),
        (None, ITEM),
        (1, "again " + ITEM),
    ]
    items = items_of(spark, [(10, ITEM), (10, ITEM), (11, "Tiny, item!"), (12, None), (13, "..."), (None, ITEM)])
    got = sorted((str(r.doc_id), str(r.item_id), r.shared) for r in contaminated(docs_of(rows), items).collect())
    full = [(d, i, 14) for d in ("1", "1", "None") for i in ("10", "None")] + [("2", "10", 12), ("2", "None", 12)]
    assert got == sorted([*full, ("4", "11", 1)])


def test_every_item_at_the_threshold_is_found():
    """Whichever shingles are missing, the sketch holds one of those that are there."""
    for size in (1, 2, 5, 9, 30, 63, 64, 100):
        text = " ".join(f"w{i}" for i in range(size + 4))
        block = Items([(1, text)])
        own = block.exact[0][1]
        assert len(own) == size
        sketch = [s for s, items in block.sketch.items() if items]
        assert len(sketch) > size - need(size)


def test_empty_tables(spark, docs_of):
    assert contaminated(docs_of([]), items_of(spark, [(1, ITEM)])).collect() == []
    assert contaminated(docs_of([(1, ITEM)]), items_of(spark, [])).collect() == []
    assert clean(docs_of([(1, ITEM)]), items_of(spark, [])).count() == 1


def test_blocks_of_items_are_searched_one_after_the_other(spark, docs_of, monkeypatch):
    """However many blocks, a plan holds the search of one at most, and each block is released."""
    monkeypatch.setattr(decontaminate, "BLOCK_SHINGLES", 20)
    texts = [" ".join(f"w{i}x{j}" for j in range(12)) for i in range(9)]
    docs = docs_of([(i, f"a {t} b") for i, t in enumerate(texts)] + [(99, "clean words only")])
    items = items_of(spark, [(i, t) for i, t in enumerate(texts)])
    released = []
    destroy = Broadcast.destroy
    monkeypatch.setattr(Broadcast, "destroy", lambda self, *a: (released.append(self), destroy(self, *a))[1])
    got = contaminated(docs, items)
    assert sorted((r.doc_id, r.item_id, r.shared) for r in got.collect()) == [(i, i, 8) for i in range(9)]
    assert len(released) > 2 and "search" not in got._jdf.queryExecution().toString()
    assert [r.doc_id for r in clean(docs, items).collect()] == [99]
