"""Dense, deterministic surrogate ids.

Rule: ``id = start + row_number() over (order by natural key)``.  A global
``row_number`` window runs in one task, so instead:

1. range-partition and sort by the key (a distributed sort); each row is
   tagged with its range partition ``_p`` and its position ``_l`` inside
   it, and the tagged rows are written once to the shared checkpoint folder
   (a lineage cut: a lost executor cannot re-cut the ranges, because the
   partition bounds are fixed before the write and the tags are stored);
2. rows per range partition are counted from the written ``_p`` column (one
   number per partition reaches the driver);
3. id = start + rows in earlier partitions + ``_l`` + 1, a map-side join with
   one row per range partition.

The natural key must be unique; callers dedupe first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import PACKED, passing_path

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the row index in the low 33 bits


def range_tagged(df: DataFrame, order_by: list[str | Column],
                 num_partitions: int | None = None, name: str = "ranged") -> DataFrame:
    """Rows range-partitioned and sorted by ``order_by``, tagged with their
    range partition ``_p`` and position ``_l`` in it, written once to the
    shared checkpoint folder and read back (tags fixed, lineage cut)."""
    spark = df.sparkSession
    keys = [F.col(c) if isinstance(c, str) else c for c in order_by]
    # Without an explicit count AQE sizes the ranges from the data; coalescing
    # merges only neighbouring ranges, so partition order stays key order.
    ranged = (df.repartitionByRange(num_partitions, *keys) if num_partitions
              else df.repartitionByRange(*keys)).sortWithinPartitions(*keys)
    mid = F.monotonically_increasing_id()
    tagged = ranged.select("*", F.spark_partition_id().alias("_p"),
                           (mid - F.shiftleft(F.shiftright(mid, _LOCAL_BITS), _LOCAL_BITS))
                           .alias("_l"))
    path = passing_path(spark, name)
    tagged.write.options(**PACKED).parquet(path)
    return spark.read.parquet(path)


def assign_dense_ids(df: DataFrame, order_by: list[str | Column], id_col: str = "id",
                     start: int | Column = 0, num_partitions: int | None = None) -> DataFrame:
    """Add ``id_col`` = start + 1-based rank of each row in ``order_by`` order."""
    fixed = range_tagged(df, order_by, num_partitions, name="ids")
    # One row a range partition: rows in earlier partitions, a small table that
    # the planner broadcasts.
    counts = fixed.groupBy("_p").agg(F.count(F.lit(1)).alias("n")).collect()
    earlier, running = [], 0
    for r in sorted(counts, key=lambda r: r["_p"]):
        earlier.append((int(r["_p"]), running))
        running += int(r["n"])
    offsets = fixed.sparkSession.createDataFrame(earlier, "_p int, _before long")
    start_col = start if isinstance(start, Column) else F.lit(int(start))
    out = fixed.join(F.broadcast(offsets), "_p").withColumn(
        id_col, (start_col + F.col("_before") + F.col("_l") + 1).cast("long")).drop("_p", "_l", "_before")
    return out.select(id_col, *[c for c in out.columns if c != id_col])
