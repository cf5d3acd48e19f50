"""The (key, value) level of a lookup source.

A source is grouped once, to one row per normalised key and distinct normalised value with its count and
first row. The lookup's table (one row per key), its conflicting values and the joined text of its
exceptions all come from that level, which can be written once and read by each of them. A key never
collects its values: joined text is cut into numbered chunks of a bounded number of values, so a key
with very many free-text values is dealt to many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import col_of, text_key
from ..plans.session import cut_lineage

MATCHED = "MATCHED"
NOT_FOUND = "NOT_FOUND"
DUPLICATE_CONFLICT = "DUPLICATE_CONFLICT"

#: Values that one chunk of joined text holds at most.
CHUNK_VALUES = 1000


def order_struct(order_by: Sequence[str | Column]) -> Column:
    """Row order made explicit (S1): the struct of the ordering columns."""
    if not order_by:
        raise ValueError("order_by is required: first-row semantics need an explicit order")
    return F.struct(*[col_of(c) for c in order_by])


def keyed_agg(rows: DataFrame, key: str, *aggs: Column) -> DataFrame:
    """``groupBy(key).agg(...)`` without the null-key group.

    The null test is an aggregate output (``max(key IS NOT NULL)``), not a
    filter on the grouping column: Spark pushes grouping-column filters below
    the aggregate, which would evaluate an expensive key expression (regex
    chains) a second time per input row. The null group itself costs one
    partial row per task."""
    out = (
        rows.groupBy(key).agg(*aggs, F.max(F.col(key).isNotNull()).alias("__has_key"))
        .filter(F.col("__has_key")).drop("__has_key")
    )
    # Declare the key non-nullable (the null group is gone): a later equi-join
    # then infers no IsNotNull(key) filter, which Spark would otherwise push
    # below this aggregate and evaluate per input row.
    return out.withColumn(key, F.coalesce(F.col(key), F.lit("").cast(out.schema[key].dataType)))


def newest_first(d: Column, dtype: str, order: Column) -> Column:
    """Orders rows by date, newest first, then by ``order``; a null date comes after every real one.

    Microseconds since the epoch are taken without the session time zone for
    wall-clock types (timestamp_ntz, date): a DST gap would otherwise map
    distinct wall-clock times to the same instant."""
    if dtype == "timestamp":
        micros = F.unix_micros(d)
    else:
        t = d.cast("timestamp_ntz")
        days = F.datediff(F.to_date(t), F.lit("1970-01-01").cast("date")).cast("bigint")
        micros = (
            days * 86_400_000_000 + F.hour(t).cast("bigint") * 3_600_000_000 + F.minute(t).cast("bigint") * 60_000_000
            + F.second(t).cast("bigint") * 1_000_000 + F.date_format(t, "SSSSSS").cast("bigint")
        )
    return F.struct(F.coalesce(-micros, F.lit(2**62).cast("bigint")).alias("age"), order.alias("o"))


class ValueLevel:
    """One row per (normalised key, distinct normalised value) of a source.

    Rows without a key or a normalised value carry no mapping and are dropped.
    ``key_original`` is the key text that exceptions show. With a ``date``,
    each value keeps its newest row too."""

    def __init__(
        self,
        source: DataFrame,
        key: Column,
        value: str | Column,
        norm: Column | None = None,
        order_by: Sequence[str | Column] = (),
        date: Column | None = None,
        key_original: Column | None = None,
    ):
        v = col_of(value).cast("string") if isinstance(value, str) else value
        n = norm if norm is not None else text_key(v)
        ko = (key_original if key_original is not None else key).cast("string")
        self.dated = date is not None
        rows = source.select(
            key.alias("_k"), n.alias("_n"), F.struct(order_struct(order_by).alias("o"), v.alias("v"), ko.alias("ko")).alias("_r"),
            *([date.alias("_d")] if self.dated else []))
        aggs = [F.min("_r").alias("first"), F.count(F.lit(1)).alias("n_rows"),
                F.max(F.col("_k").isNotNull() & F.col("_n").isNotNull()).alias("_ok")]
        if self.dated:
            age = newest_first(F.col("_d"), rows.schema["_d"].dataType.simpleString(), F.col("_r.o"))
            aggs += [F.min(F.struct(age.alias("age"), F.col("_r.v").alias("v"))).alias("newest"), F.max("_d").alias("last")]
        # the null test is an aggregate output: not pushed below the aggregate
        level = rows.groupBy("_k", "_n").agg(*aggs).filter(F.col("_ok")).drop("_ok")
        # neither is null from here on: said here, so that no filter on the key expressions is inferred
        self.frame = level.withColumns({c: F.coalesce(F.col(c), F.lit("").cast(level.schema[c].dataType)) for c in ("_k", "_n")})
        self._is_written = False

    def written(self) -> ValueLevel:
        """Writes the level (once), so that whatever is taken from it groups the source no more."""
        if not self._is_written:
            self.frame, self._is_written = cut_lineage(self.frame), True
        return self

    def table(self) -> DataFrame:
        """One row per key: ``_k, value, status, n_rows, resolved_by_date, n_values, first_key, min_key``.

        One distinct value: MATCHED with its first original text. Several: the newest one where some row
        has a date, else DUPLICATE_CONFLICT without a value."""
        aggs = [F.count(F.lit(1)).alias("n_values"), F.sum("n_rows").alias("n_rows"), F.min("first").alias("_f"),
                F.min("first.ko").alias("min_key")]
        if self.dated:
            aggs += [F.min("newest").alias("_newest"), F.max("last").alias("_last")]
        per_key = keyed_agg(self.frame, "_k", *aggs)
        single = F.col("n_values") == 1
        by_date = (~single & F.col("_last").isNotNull()) if self.dated else F.lit(False)
        value = F.when(single, F.col("_f.v"))
        if self.dated:
            value = value.when(by_date, F.col("_newest.v"))
        return per_key.select(
            "_k", value.alias("value"), F.when(single | by_date, F.lit(MATCHED)).otherwise(F.lit(DUPLICATE_CONFLICT)).alias("status"),
            "n_rows", by_date.alias("resolved_by_date"), "n_values", F.col("_f.ko").alias("first_key"), "min_key")

    def conflicts(self) -> DataFrame:
        """The values of keys that have several: ``_k, norm, value, key_original`` (of the value's first row)."""
        several = keyed_agg(self.frame.select("_k"), "_k", F.count(F.lit(1)).alias("_nv")).filter("_nv > 1")
        rows = self.frame.join(several.select("_k"), "_k", "left_semi")
        return rows.select("_k", F.col("_n").alias("norm"), F.col("first.v").alias("value"), F.col("first.ko").alias("key_original"))


def value_chunks(values: DataFrame, group: Sequence[str], size: int = CHUNK_VALUES) -> DataFrame:
    """``value`` and ``key_original`` of each group as sorted ``'; '``-joined text, in chunks numbered from 0 of
    ``size`` values at most: ``*group, chunk, observed, observed_keys``. ``value`` is distinct within a group.

    The rows are sorted by range over (group, value), so that a large group is dealt to many tasks; a value's
    rank is its place in its part of the group plus the sizes of the parts before."""
    order = [*group, "value"]
    n = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = values.repartitionByRange(n, *order).sortWithinPartitions(*order)
    placed = cut_lineage(dealt.withColumn("_seq", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_seq", 33)))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy(*group, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_seq").alias("_first"))
    parts = parts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    rank = F.col("_before") + F.col("_seq") - F.col("_first")
    ranked = placed.join(parts, [*group, "_part"]).withColumn("chunk", F.floor(rank / size).cast("int"))
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(F.collect_list(c))), "; ")  # noqa: E731  (of one chunk)
    return ranked.groupBy(*group, "chunk").agg(joined("value").alias("observed"), joined("key_original").alias("observed_keys"))
