"""Result writers.

Every result table goes to its own directory through Spark's output
committer, so each table appears whole or not at all. A run is complete when
a numbered manifest names its tables: the manifest is written beside its
place and then renamed into it, never over another one, so that a crash at
any point leaves the newest complete run readable. No machine-local paths
are involved; ``run_dir`` is any shared filesystem or object-store URI.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFESTS = "_manifests"


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """A10: parquet keeps types; CSV writes a header and nulls as blank."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w.option("header", True).option("nullValue", "").option("emptyValue", "").csv(path)
    elif fmt == "parquet":
        w.parquet(path)
    elif fmt == "json":
        w.json(path)
    else:
        raise ValueError(f"unsupported output format: {fmt}")


def _files(spark: SparkSession, path: str):
    """Spark's own view of the filesystem that ``path`` is on, and the path in it."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def manifests(spark: SparkSession, run_dir: str) -> list[int]:
    """The numbers of the complete manifests, in order. A folder is complete
    when Spark's committer has marked it."""
    base = f"{run_dir.rstrip('/')}/{MANIFESTS}"
    files, where = _files(spark, base)
    if not files.exists(where):
        return []
    names = [s.getPath().getName() for s in files.listStatus(where)]
    done = [n for n in names if n.isdigit() and files.exists(_files(spark, f"{base}/{n}/_SUCCESS")[1])]
    return sorted(map(int, done))


def _publish(spark: SparkSession, manifest: DataFrame, base: str) -> int:
    """Writes the manifest beside its place and renames it to the next free number."""
    staged = f"{base}/{MANIFESTS}/_staged-{uuid.uuid4().hex}"
    manifest.coalesce(1).write.json(staged)
    files, source = _files(spark, staged)
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    taken = [s.getPath().getName() for s in files.listStatus(source.getParent())]
    number = max((int(n) for n in taken if n.isdigit()), default=0)
    while True:
        number += 1
        target = _files(spark, f"{base}/{MANIFESTS}/{number:09d}")[1]
        try:
            context.rename(source, target, options)  # fails where the number is taken
            return number
        except Exception:
            if not files.exists(target):
                raise


def write_run(tables: Mapping[str, DataFrame], run_dir: str, fmt: str = "parquet") -> str:
    """Write every table into a fresh folder ``run_dir/run-<id>`` and then
    publish a manifest (one row per table) that names it, under the next
    number. Until then readers see the previous run whole; a failed run
    leaves only unnamed folders. Returns ``run_dir``."""
    base = run_dir.rstrip("/")
    run = f"{base}/run-{uuid.uuid4().hex}"
    spark = None
    for name, df in tables.items():
        write_table(df, f"{run}/{name}", fmt, mode="errorifexists")
        spark = df.sparkSession
    if spark is not None:
        _publish(spark, spark.createDataFrame([(n, f"{run}/{n}", fmt) for n in tables], "table string, path string, format string"), base)
    return base


def read_run(spark: SparkSession, run_dir: str, number: int | None = None) -> dict[str, DataFrame]:
    """Open the newest complete run, or the one with a ``number``; raises if there is none."""
    base = run_dir.rstrip("/")
    known = manifests(spark, base)
    if not known or (number is not None and number not in known):
        raise FileNotFoundError(f"no complete run{'' if number is None else f' {number}'} under {run_dir}")
    m = spark.read.json(f"{base}/{MANIFESTS}/{known[-1] if number is None else number:09d}").collect()  # one row per table
    out = {}
    for r in m:
        out[r["table"]] = spark.read.format(r["format"]).option("header", True).load(r["path"])
    return out


def blank_nulls(df: DataFrame) -> DataFrame:
    """A10: nulls as empty text (display form)."""
    return df.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in df.columns])
