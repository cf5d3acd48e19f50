"""Exact deduplication by two-pass Bloom filtering, in DataFrame operations only.

Pass 1 throws ``hashes`` bits per row into a filter and keeps the bits that at least two rows hit.
Pass 2 tests every row against these bits: a row whose bits were all hit twice may be repeated, and
only such rows are shuffled and grouped by their SHA-256. The rest pass straight through.

A false positive is a row that is grouped alone, so the result is exact whatever the filter's size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import cut, lower_ascii, numbered, table

BITS_PER_ROW = 32
HASHES = 2
MIN_BITS = 1 << 16
#: The filter is sent to executors as 64-bit words: MAX_BITS / 64 entries of 16 bytes at most.
MAX_BITS = 1 << 30


def filter_bits(rows: int, max_bits: int = MAX_BITS) -> int:
    """A power of two of at least BITS_PER_ROW bits a row, between MIN_BITS and ``max_bits``."""
    wanted = max(MIN_BITS, BITS_PER_ROW * rows)
    return min(max_bits, 1 << (wanted - 1).bit_length())


def _bit(j: int, bits: int) -> Column:
    return F.xxhash64(F.col("text_sha256"), F.lit(j)).bitwiseAND(F.lit(bits - 1).cast("long"))


def _word(bit: Column) -> Column:
    return F.shiftright(bit, 6)


def _mask(bit: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(63).cast("int"))


def repeated_bits(keyed: DataFrame, bits: int, hashes: int = HASHES) -> DataFrame:
    """Pass 1: (word, mask) of the filter bits that two or more rows hit."""
    hits = keyed.select(F.explode(F.array(*[_bit(j, bits) for j in range(hashes)])).alias("bit"))
    twice = hits.groupBy("bit").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return twice.groupBy(_word(F.col("bit")).alias("word")).agg(F.bit_or(_mask(F.col("bit"))).alias("mask"))


def maybe_repeated(keyed: DataFrame, words: DataFrame, bits: int, hashes: int = HASHES) -> DataFrame:
    """Pass 2: adds ``maybe``, false only for rows whose hash no other row has."""
    out, maybe = keyed, F.lit(True)
    for j in range(hashes):
        side = F.broadcast(words.select(F.col("word").alias(f"word{j}"), F.col("mask").alias(f"mask{j}")))
        out = out.withColumn(f"word{j}", _word(_bit(j, bits))).join(side, f"word{j}", "left")
        mask = F.coalesce(F.col(f"mask{j}"), F.lit(0).cast("long"))
        maybe = maybe & (mask.bitwiseAND(_mask(_bit(j, bits))) != 0)
    return out.select(*keyed.columns, maybe.alias("maybe"))


def exact_dedup(docs: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; a null text counts as empty. The row with
    the largest doc_id of a group stays (null ids are smallest); of repeated rows with that same id
    exactly one stays. Other columns are ignored. An empty table gives an empty result.
    """
    keyed = cut(numbered(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.sha2(lower_ascii("text"), 256).alias("text_sha256"))))
    bits = filter_bits(keyed.count(), max_bits)
    tested = cut(maybe_repeated(keyed, repeated_bits(keyed, bits), bits))
    again, once = tested.where("maybe"), tested.where("not maybe")
    # written, so that both sides of the join below are plain exchanges: a group with a third of all
    # rows is then a skewed partition that adaptive execution splits
    groups = cut(
        again.groupBy("text_sha256").agg(F.max(F.struct("doc_id", "rid")).alias("keep"), F.count(F.lit(1)).alias("group_size"))
    )
    grouped = again.join(groups, "text_sha256").select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        "group_size",
        (F.col("rid") == F.col("keep.rid")).alias("kept"),
        "text_sha256",
    )
    alone = once.select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256"
    )
    return alone.unionByName(grouped)


SQL = """
WITH k AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents
)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM k WINDOW g AS (PARTITION BY text_sha256)
"""


def op3_bloom_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))
