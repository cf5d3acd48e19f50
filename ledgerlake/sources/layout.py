"""Stored layouts that later runs join and prune by.

A master and the tables it is looked up in, bucketed by the lookup key into the
same number of buckets, join without an exchange on either side. Sales history
partitioned by month is read for the months before the reporting month only:
the month is found when the query runs, and reaches the scan as a partition
filter.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.history import as_date, row_mean

_LAYOUT = "_layout"


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """Writes ``df`` as Parquet under ``path``, bucketed and sorted by ``key``, with a note of its layout beside
    the files; returns the table. Rows are dealt by the key before they are written, so that each
    bucket is one file."""
    spark = df.sparkSession
    name = f"stored_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, F.col(f"`{key}`"))
    dealt.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", f"{path}/data").mode("errorifexists").saveAsTable(name)
    note = json.dumps({"key": key, "buckets": buckets, "schema": df.schema.json()})
    spark.createDataFrame([(note,)], "note string").coalesce(1).write.text(f"{path}/{_LAYOUT}")
    return spark.table(name)


def open_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """A table that an earlier session wrote with ``write_bucketed``, known to this session as bucketed."""
    note = json.loads(spark.read.text(f"{path}/{_LAYOUT}").first()[0])
    from pyspark.sql.types import StructType

    schema = StructType.fromJson(json.loads(note["schema"]))
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    name, key = f"stored_{uuid.uuid4().hex}", note["key"]
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {note['buckets']} BUCKETS LOCATION '{path}/data'")
    return spark.table(name)


def month_number(year: Column, month: Column) -> Column:
    """Months as consecutive integers."""
    return (year * 12 + month - 1).cast("int")


def write_history(sales: DataFrame, path: str, key: Column, date: Column, value: Column) -> DataFrame:
    """Monthly totals per key (``_k, value, month``), partitioned by month; rows without a date are left out."""
    day = as_date(sales, date)
    rows = sales.select(key.alias("_k"), month_number(F.year(day), F.month(day)).alias("month"), value.alias("v"))
    totals = rows.filter("month is not null").groupBy("_k", "month").agg(F.sum("v").alias("value"))
    totals.repartition("month", "_k").write.partitionBy("month").parquet(path)
    return open_history(sales.sparkSession, path, totals)


def open_history(spark: SparkSession, path: str, like: DataFrame | None = None) -> DataFrame:
    return spark.read.schema(like.schema).parquet(path) if like is not None else spark.read.parquet(path)


def prior_months_stored(stored: DataFrame, period: DataFrame, n: int = 3) -> DataFrame:
    """H2 on stored history: ``_k, m1..mn, average`` for the n months before the reporting month in ``period`` (one row
    ``year, month``). The month is a scalar subquery on the partition column, so other months' files are not opened."""
    at = period.select(month_number(F.col("year"), F.col("month"))).scalar()
    inside = stored.filter((F.col("month") >= at - n) & (F.col("month") < at))
    slot = F.col("month") - at + n
    wide = inside.groupBy("_k").agg(*[F.sum(F.when(slot == i, F.col("value"))).alias(f"m{i + 1}") for i in range(n)])
    return wide.withColumn("average", row_mean([F.col(f"m{i + 1}") for i in range(n)]))
