"""Benchmark decontamination by size-partitioned MinHash containment search.

Items are partitioned by their number of shingles into powers of two. A partition fixes the length of
its items' MinHash sketch: the s smallest shingle hashes, with s one more than the number of shingles
that an item of the partition's largest size may miss at the threshold. So at least one sketch
shingle of an item is in every document that contains enough of it, and a document shorter than a
partition's need is not searched for its items. Items whose sketch is hit are verified by their exact
shingle containment. Only the short side is sketched; documents of any length are searched whole.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from ledgerlake.llm.common import cut, table, whole_text
from ledgerlake.llm.words import words_of

SHINGLE_WORDS = 5
THRESHOLD = 0.8
#: Items are searched in blocks of about this many shingles, so what is sent to executors is bounded.
BLOCK_SHINGLES = 200_000

HITS = ArrayType(
    StructType([StructField("item", LongType()), StructField("shared", LongType()), StructField("item_shingles", LongType())])
)


def shingles(words: list[bytes], k: int = SHINGLE_WORDS) -> set[bytes]:
    """The distinct k-word shingles; fewer words are one shingle."""
    if not words:
        return set()
    return {b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))}


def need(size: int, threshold: float = THRESHOLD) -> int:
    """The shingles of an item that a document must contain."""
    return max(1, math.ceil(threshold * size - 1e-9))


class Items:
    """A block of items as lookups: sketch shingle -> items, and each item's exact shingles."""

    def __init__(self, rows: list[tuple[int, str | None]], threshold: float = THRESHOLD):
        self.threshold = threshold
        self.exact: list[tuple[int, set[bytes]]] = []
        self.sketch: dict[bytes, list[int]] = {}
        for item, text in rows:
            own = shingles(words_of((text or "").encode()))
            if not own:
                continue
            largest = (1 << len(own).bit_length()) - 1  # of the partition's sizes
            length = min(len(own), largest - need(largest, threshold) + 1)
            for s in sorted(own, key=xxhash.xxh64_intdigest)[:length]:
                self.sketch.setdefault(s, []).append(len(self.exact))
            self.exact.append((item, own))
        #: Words of the sketch; a document shingle with any other word can't be in it.
        self.vocabulary = {w: True for s in self.sketch for w in s.split()}

    def find(self, text: bytes) -> list[tuple[int, int, int]]:
        """(item, shared, item_shingles) of the items that the text contains."""
        words = words_of(text)
        if not words:
            return []
        k = min(SHINGLE_WORDS, len(words))
        known = np.fromiter(map(self.vocabulary.__contains__, words), np.bool_, len(words))
        runs = np.convolve(known, np.ones(k, np.int32), "valid") if known.any() else np.zeros(0, np.int32)
        room = len(words) - k + 1
        found: set[int] = set()
        for i in np.flatnonzero(runs == k).tolist():
            found.update(self.sketch.get(b" ".join(words[i : i + k]), ()))
        found = {i for i in found if need(len(self.exact[i][1]), self.threshold) <= room}
        if not found:
            return []
        have, out = shingles(words), []
        for i in sorted(found):
            item, own = self.exact[i]
            shared = len(own & have)
            if shared >= need(len(own), self.threshold):
                out.append((item, shared, len(own)))
        return out


def _blocks(items: DataFrame) -> Iterator[tuple[list[tuple[int, str | None]], bool]]:
    """The items in blocks of about BLOCK_SHINGLES shingles, and whether there is one only; a block is what
    the driver holds."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    words = rows.agg(F.sum(F.regexp_count(whole_text("text"), F.lit(r"\S+")))).first()[0] or 0
    parts = max(1, -(-words // BLOCK_SHINGLES))
    for p in range(parts):
        block = rows.where(F.pmod(F.xxhash64("item_id", whole_text("text")), F.lit(parts)) == p)
        yield [tuple(r) for r in block.distinct().collect()], parts == 1


def _search(sent) -> Callable[[Column], Column]:
    @F.pandas_udf(HITS)
    def search(texts: pd.Series) -> pd.Series:
        return pd.Series([sent.value.find(t.encode()) for t in texts], dtype=object)

    return lambda text: search(whole_text(text))


def _each_block(items: DataFrame, threshold: float, run: Callable[[Callable[[Column], Column], bool], None]) -> None:
    """``run`` with the search of every block and whether it is the only one; else ``run`` writes what it
    finds, and the block is released after it."""
    context = items.sparkSession.sparkContext
    for rows, only in _blocks(items):
        sent = context.broadcast(Items(rows, threshold))
        run(_search(sent), only)
        if not only:
            sent.destroy()


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, item_id, shared, item_shingles, containment: a row per document row and item it contains.

    Shingles are five words of lower-cased letters and digits; a text of fewer words is one shingle, and
    one without words (null, empty) contains nothing and is contained in nothing. An item is contained
    when at least ``threshold`` of its distinct shingles are in the document. Repeated documents give
    rows of their own, repeated items (same id and text) one. Other columns are ignored; an empty table on
    either side gives an empty result.
    """
    parts: list[DataFrame] = []

    def run(search: Callable[[Column], Column], only: bool) -> None:
        found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.explode(search(F.col("text"))).alias("hit"))
        parts.append(found if only else cut(found))

    _each_block(items, threshold, run)
    return reduce(DataFrame.unionByName, parts).select(
        "doc_id",
        F.col("hit.item").alias("item_id"),
        "hit.shared",
        "hit.item_shingles",
        (F.col("hit.shared") / F.col("hit.item_shingles")).alias("containment"),
    )


def clean(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that contain an item; no row is shuffled.

    With several blocks of items, what each leaves is written for the next. Columns stay as they are, whatever
    their names. A null or empty text holds no item and stays, as does every row when there are no items; repeated
    rows go or stay together; very long texts are searched whole. An empty table gives an empty one.
    """
    left = docs

    def run(search: Callable[[Column], Column], only: bool) -> None:
        nonlocal left
        left = left.where(F.size(search(F.col("text"))) == 0)
        left = left if only else cut(left)

    _each_block(items, threshold, run)
    return left


SQL = f"""
WITH words AS (
  SELECT 'd' AS kind, doc_id AS id, row_number() OVER () AS rid, text FROM documents
  UNION ALL SELECT DISTINCT 'i', item_id, 0, text FROM benchmark
),
split AS (
  SELECT kind, id, rid, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM words
),
shingles AS (
  SELECT DISTINCT kind, id, rid, unnest(list_transform(range(1, greatest(2, len(w) - {SHINGLE_WORDS - 2})),
    lambda i: array_to_string(w[i:i + {SHINGLE_WORDS - 1}], ' '))) AS s FROM split WHERE len(w) > 0
),
sizes AS (SELECT id, count(*) AS item_shingles FROM shingles WHERE kind = 'i' GROUP BY id),
shared AS (
  SELECT d.id AS doc_id, d.rid, i.id AS item_id, count(*) AS shared FROM shingles d JOIN shingles i ON d.s = i.s
  WHERE d.kind = 'd' AND i.kind = 'i' GROUP BY ALL
)
SELECT doc_id, item_id, shared, item_shingles, shared / item_shingles AS containment
FROM shared JOIN sizes ON sizes.id = item_id WHERE shared >= {THRESHOLD} * item_shingles - 1e-9
"""


def op8_minhash_containment(spark, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
