"""SimHash near-duplicates with pigeonring filtering.

A 64-bit fingerprint is cut into SEGMENTS pieces on a ring. When two fingerprints differ in at most
MAX_BITS bits, some piece starts a chain in which the first l pieces together differ in at most
l * MAX_BITS / SEGMENTS bits, for every l (the pigeonring principle). With 5 pieces and 4 bits the
budgets are 0, 1, 2, 3, 4: the first piece is equal and the second differs in one bit at most, which
makes an equality key; the longer chains prune candidates before the full Hamming check.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ledgerlake.llm.common import ROW_KEY, cut, pick, table, whole_text, with_row_key
from ledgerlake.llm.components import components

SHINGLE_WORDS = 4
HASH_SEED = 42
MAX_BITS = 4
SEGMENTS = 5
BITS = 64
#: Buckets with more fingerprints than this are split by keys over the bits that theirs leaves open.
HOT_BUCKET = 4096
#: Shingle hashes held at once.
CHUNK = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE_WORDS) -> int:
    """A bit is 1 when it is set in over half the shingles' XXH64; no words give 0."""
    words = text.lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths + 1) - lengths - 1
    k = min(shingle, len(words))
    first, last = starts[: len(words) - k + 1], (starts + lengths)[k - 1 :]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, len(first), CHUNK):
        spans = zip(first[at : at + CHUNK].tolist(), last[at : at + CHUNK].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], HASH_SEED) for a, b in spans], np.uint64)
        ones += np.unpackbits(hashes.astype("<u8").view(np.uint8), bitorder="little").reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(first), bitorder="little").view("<u8")[0])


@F.pandas_udf(LongType())
def fingerprints(texts: pd.Series) -> pd.Series:
    """The fingerprints as signed longs."""
    return pd.Series(np.array([fingerprint(t.encode()) for t in texts], np.uint64).view(np.int64))


def ring(width: int, offset: int = 0) -> list[tuple[int, int]]:
    """(shift, bits) of SEGMENTS pieces of ``width`` bits, the wider ones first."""
    out = []
    for i in range(SEGMENTS):
        bits = width // SEGMENTS + (i < width % SEGMENTS)
        out.append((offset, bits))
        offset += bits
    return out


def _piece(fp: Column, shift: int, bits: int) -> Column:
    return F.shiftrightunsigned(fp, shift).bitwiseAND((1 << bits) - 1)


def _keys(fp: Column, pieces: list[tuple[int, int]], start: int) -> list[Column]:
    """The chain key at ``start``, then the keys with one 0 bit of the second piece set.

    Of two fingerprints that differ in one bit there, the one with the 0 meets the other's own key.
    """
    first, second = pieces[start], pieces[(start + 1) % SEGMENTS]
    own = F.shiftleft(_piece(fp, *first), second[1]).bitwiseOR(_piece(fp, *second))
    flips = [F.when(F.shiftrightunsigned(own, b).bitwiseAND(1) == 0, own.bitwiseOR(1 << b)) for b in range(second[1])]
    return [own, *flips]


def _tagged(keys: list[Column], start: int) -> list[Column]:
    return [F.shiftleft(F.lit(start).cast("long"), 40).bitwiseOR(k) for k in keys]


def buckets(prints: DataFrame, hot: int = HOT_BUCKET) -> DataFrame:
    """start, key, sub, fp: every two fingerprints within MAX_BITS share a bucket of some valid start.

    A bucket with more than ``hot`` fingerprints of its own key is split: the bits that its key leaves
    open form a ring again, whose chain keys are its sub-buckets. No bucket is capped.
    """
    pieces = ring(BITS)
    fp = F.col("fp")
    own = prints.select(F.explode(F.array(*[_tagged(_keys(fp, pieces, s)[:1], s)[0] for s in range(SEGMENTS)])).alias("key"))
    crowded = cut(own.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot).select("key", F.lit(True).alias("crowded")))
    keys = [k for s in range(SEGMENTS) for k in _tagged(_keys(fp, pieces, s), s)]
    rows = prints.select("fp", F.explode(F.array_compact(F.array(*keys))).alias("key"))
    rows = rows.withColumn("start", F.shiftrightunsigned("key", 40).cast("int"))
    if crowded.isEmpty():
        return rows.select("start", "key", F.lit(0).cast("long").alias("sub"), "fp")
    rows = rows.join(crowded, "key", "left")
    sub = F.array(F.lit(0).cast("long"))
    for s in range(SEGMENTS):
        inner = ring(BITS - pieces[s][1] - pieces[(s + 1) % SEGMENTS][1])
        open_bits = F.lit(0).cast("long")  # the pieces after the key's two, side by side
        at = 0
        for i in range(2, SEGMENTS):
            shift, bits = pieces[(s + i) % SEGMENTS]
            open_bits = open_bits.bitwiseOR(F.shiftleft(_piece(fp, shift, bits), at))
            at += bits
        keys = [k for t in range(SEGMENTS) for k in _tagged(_keys(open_bits, inner, t), t + 1)]
        sub = F.when(F.col("crowded") & (F.col("start") == s), F.array_compact(F.array(*keys))).otherwise(sub)
    return rows.select("start", "key", F.explode(sub).alias("sub"), "fp")


def _masks() -> np.ndarray:
    """masks[start, l]: the bits of the first l + 1 pieces of the chain from ``start``."""
    out = np.zeros((SEGMENTS, SEGMENTS), np.uint64)
    for start in range(SEGMENTS):
        mask = 0
        for i in range(SEGMENTS):
            shift, bits = ring(BITS)[(start + i) % SEGMENTS]
            mask |= ((1 << bits) - 1) << shift
            out[start, i] = mask
    return out


def near(diff: np.ndarray, start: np.ndarray | int, masks: np.ndarray) -> np.ndarray:
    """Which differences keep every chain budget from ``start``; the last budget is the Hamming check."""
    keep = np.arange(len(diff))
    for i in range(SEGMENTS):
        mask = masks[start, i] if np.isscalar(start) else masks[start[keep], i]
        keep = keep[np.bitwise_count(diff[keep] & mask) <= (i + 1) * MAX_BITS // SEGMENTS]
    return keep


def _spread(fps: np.ndarray, start: int, masks: np.ndarray, out: list) -> None:
    """Links that connect a bucket: from each fingerprint reached to those not reached yet."""
    rest = fps
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            here = queue.pop()
            hit = near(rest ^ here, start, masks)
            if len(hit):
                found = rest[hit]
                out.append((np.full(len(found), here), found))
                queue.extend(found)
                rest = np.delete(rest, hit)


def _link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links inside each bucket of rows sorted by (start, key, sub); a bucket may span batches."""
    masks = _masks()
    held: list[np.ndarray] = []

    def done(table: np.ndarray) -> pa.RecordBatch | None:
        edge = np.flatnonzero((table[1:, :3] != table[:-1, :3]).any(axis=1)) + 1
        at, upto = np.r_[0, edge], np.r_[edge, len(table)]
        size, out = upto - at, []
        two = at[size == 2]
        a, b = table[two, 3].view(np.uint64), table[two + 1, 3].view(np.uint64)
        keep = near(a ^ b, table[two, 0], masks)
        out.append((a[keep], b[keep]))
        for lo, hi in zip(at[size > 2].tolist(), upto[size > 2].tolist(), strict=True):
            _spread(table[lo:hi, 3].view(np.uint64), int(table[lo, 0]), masks, out)
        a = np.concatenate([x for x, _ in out]).view(np.int64)
        b = np.concatenate([y for _, y in out]).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"]) if len(a) else None

    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)])
        change = np.flatnonzero((rows[1:, :3] != rows[:-1, :3]).any(axis=1))
        if held and (held[-1][-1, :3] != rows[0, :3]).any():
            whole = np.concatenate(held)
            held = []
            if (got := done(whole)) is not None:
                yield got
        if len(change):
            whole = np.concatenate([*held, rows[: change[-1] + 1]])
            held, rows = [], rows[change[-1] + 1 :]
            if (got := done(whole)) is not None:
                yield got
        held.append(np.ascontiguousarray(rows))
    if held and (got := done(np.concatenate(held))) is not None:
        yield got


def links(prints: DataFrame, hot: int = HOT_BUCKET) -> DataFrame:
    """a, b: fingerprints within MAX_BITS, enough of them to connect every two that are.

    ``prints``: distinct fingerprints in ``fp``. A bucket gives at most one link fewer than its size.
    """
    rows = buckets(prints, hot)
    dealt = rows.repartition("key", "sub").sortWithinPartitions("start", "key", "sub").select("start", "key", "sub", "fp")
    return dealt.mapInArrow(_link, "a long, b long")


def near_duplicates(docs: DataFrame, hot: int = HOT_BUCKET) -> DataFrame:
    """doc_id, row key, fp, component_id, stays for every row of ``docs``.

    ``component_id``: the smallest doc_id that links reach, the row's own included; null ids are passed
    over, and a component of null ids only has a null one. ``stays``: the row of the component with the
    smallest doc_id, then the smallest row key; repeated rows all have it. A null or empty text
    has the fingerprint zero and is linked like any other. Other columns are ignored; an empty table
    gives an empty result.
    """
    with_source = docs if "source" in docs.columns else docs.withColumn("source", F.lit(None).cast("string"))
    marked = cut(
        with_row_key(with_source.select("doc_id", "source", "text")).select(F.col("doc_id").cast("long").alias("doc_id"), *ROW_KEY, fingerprints(whole_text("text")).alias("fp"))
    )
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *ROW_KEY)
    prints = cut(marked.groupBy("fp").agg(F.min(row).alias("first")))
    linked = components(links(prints.select("fp"), hot))
    member = cut(prints.join(linked.withColumnRenamed("node", "fp"), "fp"))
    firsts = cut(member.groupBy("root").agg(F.min("first").alias("least")))
    least = cut(
        prints.join(member.join(firsts, "root").select("fp", "least"), "fp", "left").select("fp", F.coalesce("least", "first").alias("least"))
    )
    return marked.join(least, "fp").select(
        "doc_id", *ROW_KEY, "fp", F.col("least.doc_id").alias("component_id"), (row == F.col("least")).alias("stays")
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the one with the smallest doc_id, null ids last, then
    the smallest row key.

    Columns stay as they are, whatever their names. Texts that are null, empty or without words form one
    group, as their fingerprints are zero; of rows equal in id, source and text one stays. Very long texts count
    whole. An empty table gives an empty one.
    """
    keyed = docs if "source" in docs.columns else docs.withColumn("source", F.lit(None).cast("string"))
    stays = near_duplicates(keyed).where("stays").groupBy(*ROW_KEY).agg(F.count(F.lit(1)).alias("_rows"))
    return pick(keyed, cut(stays)).select(*[F.col(f"`{c}`") for c in docs.columns])


def op4_pigeonring_simhash(spark, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
