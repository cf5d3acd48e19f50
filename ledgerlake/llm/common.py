"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import string
import tempfile
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(col: Column | str) -> Column:
    """The text itself; null counts as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def lower_ascii(col: Column | str) -> Column:
    """Lower-case A-Z only: no other letter changes, so lengths and offsets stay."""
    return F.translate(whole_text(col), string.ascii_uppercase, string.ascii_lowercase)


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir, which every executor reaches.

    Only a local session (tests, a laptop) may leave it unset; it then gets a temporary folder.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if named:
        return named.rstrip("/")
    master = sc.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    made = tempfile.mkdtemp(prefix="llm-checkpoint-")
    sc.setCheckpointDir(made)
    return made


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Cuts the lineage: what follows reads the table, so a lost executor costs a file read and not the
    whole job before it, and a column is read only where it is used.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, name: str = "rid") -> DataFrame:
    """A number per row, so that repeated rows and null ids stay apart; fixed only once it is ``cut``."""
    return df.withColumn(name, F.monotonically_increasing_id())


def smallest_hashes(df: DataFrame, at: str, rows: int) -> DataFrame:
    """The ``rows`` rows with the smallest hash in ``at`` (a signed long).

    Only the share of the hash range that holds about twice as many rows is sorted, so that no task
    gets ``rows`` rows from every partition. Should that share hold too few, all rows are sorted.
    """
    total = df.count()
    if total > 4 * rows:
        near = df.where(F.col(at) < -(1 << 63) + (1 << 64) * 2 * rows // total)
        if near.count() >= rows:
            df = near
    return df.orderBy(at, *[c for c in df.columns if c != at]).limit(rows)


def before(df: DataFrame, group: list[str], bucket: str, order: list[str], value: Column, out: str) -> DataFrame:
    """``out``: the sum of ``value`` over the rows of the group that come earlier by (bucket, order).

    ``bucket`` must be monotone in the order and hold a bounded number of rows. Only bucket sums (one
    row per bucket) are ordered across a whole group; the rows themselves are ordered inside their
    bucket, so a group with a third of all rows is dealt to many tasks. ``df`` is read twice: cut it first.
    """
    whole = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    sums = df.groupBy(*group, bucket).agg(F.sum(value).alias("_sum"))
    starts = sums.select(*group, bucket, F.coalesce(F.sum("_sum").over(whole), F.lit(0)).alias("_start"))
    return (
        df.join(starts, [*group, bucket])
        .withColumn(out, F.col("_start") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .drop("_start")
    )


ROW_KEY = ["_key_a", "_key_b"]


def unused(columns: Iterable[str], name: str) -> str:
    """``name``, or a longer form of it that no column has."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def with_row_key(docs: DataFrame, names: Sequence[str] = ROW_KEY) -> DataFrame:
    """128 bits that tell a row by its id, source and text, nulls told from values; rows equal in these share them."""
    parts = [F.col("doc_id"), F.col("source"), F.col("text")]
    marks = [p.isNull() for p in parts]
    keys = F.xxhash64(*marks, *parts), F.xxhash64(F.lit(1), *reversed(parts), *marks)
    return docs.select("*", *[k.alias(n) for k, n in zip(keys, names, strict=True)])


def pick(docs: DataFrame, wanted: DataFrame, times: str | None = None) -> DataFrame:
    """The rows of ``docs`` whose key is in ``wanted``, each key once, or as often as column ``times`` says.

    ``wanted``: one row per key, cut, with ``_rows``, the rows that share it. Only keys of several rows are
    grouped, so usually the texts move once, for the join. Columns of ``docs`` may have any names.
    """
    own = docs.columns
    names = {c: unused(own, c) for c in wanted.columns}
    key = [names[k] for k in ROW_KEY]
    found = with_row_key(docs, key).join(wanted.select(*[F.col(c).alias(n) for c, n in names.items()]), key)
    rows = F.col(names["_rows"])
    if not wanted.where("_rows > 1").isEmpty():
        found = found.where(rows == 1).unionByName(found.where(rows > 1).dropDuplicates(key))
    if times:
        found = found.withColumn(unused(found.columns, "_time"), F.explode(F.sequence(F.lit(1), F.col(names[times]))))
    return found.select(*[F.col(f"`{c}`") for c in own])


def _crc_table() -> list[int]:
    out = []
    for n in range(256):
        for _ in range(8):
            n = (n >> 1) ^ (0xEDB88320 if n & 1 else 0)
        out.append(n)
    return out


def crc32_sql(text: str) -> str:
    """DuckDB expression: the unsigned CRC-32 of a text's UTF-8 bytes."""
    listed = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::BIGINT)"
    step = f"xor(crc >> 8, ({_crc_table()}::BIGINT[])[(xor(crc, b) & 255) + 1])"
    return f"xor(4294967295, list_reduce({listed}, lambda crc, b: {step}, 4294967295::BIGINT))"
