"""Session settings and lineage control.

The library never creates a cluster session on its own behalf in production;
``get_session`` is for tests, the bench and local runs. ``cut_lineage``
writes a reliable checkpoint into the shared folder named by
``spark.checkpoint.dir`` (never a machine-local folder, never
``localCheckpoint``), so a lost executor re-reads the checkpoint instead of
recomputing a long join chain.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession

# Settings that matter at scale: AQE re-plans joins from runtime sizes
# (sort-merge -> broadcast only when the measured side is small), splits
# skewed partitions of the probe side and coalesces tiny shuffle partitions.
SCALE_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

#: Deletes an execution's shuffle files when it ends; nothing else reads those of a table that was written.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: How the folders of ``cut_lineage`` begin.
TABLE = "table-"


def get_session(
    master: str | None = None, shuffle_partitions: int | None = None, app: str = "ledgerlake", checkpoint_dir: str | None = None
) -> SparkSession:
    """A session with these settings; ``checkpoint_dir`` is taken where the
    cluster names no ``spark.checkpoint.dir``."""
    master = master or os.environ.get("LEDGERLAKE_MASTER", "local[8]")
    b = SparkSession.builder.master(master).appName(app)
    for k, v in SCALE_CONF.items():
        b = b.config(k, v)
    b = (
        b.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("LEDGERLAKE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    sc = spark.sparkContext
    if checkpoint_dir and not (sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()):
        sc.setCheckpointDir(checkpoint_dir)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir`` or the folder given to
    ``get_session``. Only a local session (one process) that names none gets a
    temporary one: on a cluster a machine-local folder would not survive the
    loss of an executor."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured and (sc.master == "local" or sc.master.startswith("local[")):
        configured = tempfile.mkdtemp(prefix="ledgerlake-checkpoint-")
    if not configured:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(configured)
    return configured


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is shuffled by writes and ``first()`` in here is deleted as soon as each is done."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def first_row(df: DataFrame) -> Row | None:
    """The first row; no shuffle files are left."""
    with shuffles_dropped(df.sparkSession):
        return df.first()


def cut_lineage(df: DataFrame, *more: DataFrame) -> DataFrame:
    """Writes ``df`` as a Parquet table into the shared checkpoint folder and
    returns a DataFrame that reads it: later plans start from these files and
    read only the columns they use. What was shuffled for the table is deleted
    once it is written, so that a run of several tables holds one step's
    shuffle files at a time. ``more`` frames of the same columns are appended
    one after the other, so that only one of them lies in shuffle files."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{TABLE}{uuid.uuid4().hex}"
    with shuffles_dropped(spark):
        for part in (df, *more):
            part.write.mode("append").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(table: DataFrame) -> None:
    """Deletes a table of ``cut_lineage`` that nothing reads any more."""
    spark = table.sparkSession
    folders = {f.rpartition("/")[0] for f in table.inputFiles()}
    for folder in (f for f in folders if f.rpartition("/")[2].startswith(TABLE)):
        where = spark._jvm.org.apache.hadoop.fs.Path(folder)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
