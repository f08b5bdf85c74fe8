"""Shared Spark helpers of the operators."""

from __future__ import annotations

import ctypes

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(df: DataFrame) -> DataFrame:
    """``df``, in a session whose Arrow batches hold BATCH_BYTES at most.

    Spark's own bound is 64 MB, which every task holds several times over, in
    the JVM's buffers and in its Python worker.  A smaller setting stays."""
    conf = df.sparkSession.conf
    size = conf.get(_BATCH_SETTING).lower().rstrip("b")
    scale = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(size[-1:], 1)
    size = int(size.rstrip("kmg")) * scale
    if size <= 0 or size > BATCH_BYTES:
        conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    return df


def tidy() -> None:
    """Give a Python worker's free memory back."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library: nothing to trim


def tidied(run):
    """``run`` (batches -> batches), giving free memory back at the end of a task:
    Python workers outlive tasks and share their executor's memory."""
    def out(batches):
        try:
            yield from run(batches)
        finally:
            tidy()
    return out


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the shared checkpoint folder and read back:
    a lineage cut that survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fold(folds: int, key: str = "doc_id") -> Column:
    """crc32 of the key as text, modulo ``folds``; a null key falls in fold 0."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % F.lit(folds),
                      F.lit(0).cast("long"))


def hashed_sample(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """About ``rows`` rows, those with the least hash of ``keys``, and never more
    than twice as many; all rows where there are no more than that.  A filter by
    the hash, so no task gathers candidates of all others."""
    n = df.count()
    if n <= rows:
        return df
    place = F.xxhash64(*keys) / F.lit(2.0 ** 64) + 0.5
    return df.filter(place < rows / n).limit(2 * rows)
