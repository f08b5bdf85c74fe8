"""Session settings and the shared scratch folder.

Everything the warehouse needs from the session is set here once:
UTC session zone (the source timestamps carry no zone), AQE with skew
handling, and a shared checkpoint folder for lineage cuts and scratch tables.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

# Settings every warehouse job relies on.  Shuffle partitions are left to
# the caller (cluster size); AQE coalesces small ones at run time.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Parquet timestamps written by us stay zone-less.
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the warehouse settings to an existing session (idempotent)."""
    for key, value in SESSION_SETTINGS.items():
        try:
            spark.conf.set(key, value)
        except Exception:  # static conf already fixed by the cluster
            pass
    return spark


# Rows and shuffled bytes of one task: narrow enough that its sorts stay in the memory of
# a small executor's core (a shuffled byte is about eleven in a sort), at any input size.
ROWS_A_PARTITION = 100_000
BYTES_A_PARTITION = "8m"
_BEGIN_WITH = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def shuffle_partitions(spark: SparkSession) -> int:
    """Partitions that a shuffle begins with, before small ones are merged."""
    return int(spark.conf.get(_BEGIN_WITH, None) or spark.conf.get("spark.sql.shuffle.partitions"))


def size_shuffles(spark: SparkSession, rows: int) -> None:
    """Shuffles of the session begin with a partition per ``ROWS_A_PARTITION`` of its widest
    input, never fewer than before, and AQE merges them up to ``BYTES_A_PARTITION``: with a
    fixed number, sorts outgrow their memory and spill as the input grows."""
    spark.conf.set(_BEGIN_WITH, str(max(shuffle_partitions(spark), -(-rows // ROWS_A_PARTITION))))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", BYTES_A_PARTITION)


@contextmanager
def open_writers(spark: SparkSession, folders: int):
    """Tasks of writes inside it keep a file open per partition folder, up to ``folders``,
    in place of sorting their rows by folder."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, str(folders))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tabulark") -> SparkSession:
    """Session for tests and local benchmarks (UI off, no ports beyond Spark's own)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # One machine: list folders on the driver instead of launching a
        # listing job per read of a partitioned table (a cluster keeps its own).
        .config("spark.sql.sources.parallelPartitionDiscovery.threshold", "4096")
    )
    for key, value in SESSION_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (a shared file system).  Only a local
    session without it gets its own folder, as in tests.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    current = sc._jsc.getCheckpointDir()  # Optional[String] on the JVM side
    if configured:
        if not current.isPresent():
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if current.isPresent():
        return str(current.get()).rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a cluster job needs a shared folder")
    folder = tempfile.mkdtemp(prefix="tabulark-ckpt-")
    sc.setCheckpointDir(folder)
    return folder


# Tables we write: smaller than the default codec's by about a third.
PACKED = {"compression": "zstd"}


def stored(df, name: str):
    """``df`` written once to the shared checkpoint folder and read back, for rows
    that several outputs are taken from."""
    path = passing_path(df.sparkSession, name)
    df.write.options(**PACKED).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_PASSING: ContextVar[list[str] | None] = ContextVar("passing", default=None)


def passing_path(spark: SparkSession, name: str) -> str:
    """``scratch_path`` for rows on their way to a table: inside ``dropping_scratch``
    the folder goes when the table stands."""
    path = scratch_path(spark, name)
    held = _PASSING.get()
    if held is not None:
        held.append(path)
    return path


@contextmanager
def dropping_scratch(spark: SparkSession):
    """Deletes, at its end, the folders that ``passing_path`` gave inside it.  For steps
    that write all their outputs before they end: nothing reads the folders later."""
    held: list[str] = []
    token = _PASSING.set(held)
    try:
        yield
    finally:
        _PASSING.reset(token)
        for path in held:
            delete_folder(spark, path)


def delete_folder(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint root for a written table."""
    root = checkpoint_root(spark)
    return f"{root}/tables/{name}-{uuid.uuid4().hex[:12]}"
