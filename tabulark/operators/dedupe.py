"""Latest row per key.

The source applies changes one by one in cursor order, last one wins; a
batch upsert must pick that row first.  ``max(struct(order..., rest...))``
is an ordinary aggregate with a map-side partial step, so a key holding a
third of all rows is combined on every mapper before the shuffle (a
``row_number`` window would send that whole key to one task).  Putting
every remaining column after the order columns makes the tie-break total,
so reruns give the same row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored

# Hashes of repeated keys up to which rows of other keys are told apart by a join.
FEW_REPEATED = 1 << 17


def latest_per_key(df: DataFrame, keys: list[str], order_by: list[str],
                   descending: bool = True) -> DataFrame:
    """One row per ``keys``: the greatest (or least) by ``order_by`` then by
    all other columns."""
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    packed = F.struct(*[F.col(c) for c in order_by + rest]).alias("_v")
    pick = F.max(packed) if descending else F.min(packed)
    agg = df.groupBy(*keys).agg(pick.alias("_v"))
    return agg.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in order_by + rest]).select(*df.columns)


def newest_rows(df: DataFrame, keys: list[str], order_by: list[str] | None) -> DataFrame:
    """``latest_per_key`` (any row per key, without an order) of a feed in which few
    keys repeat: rows whose key stands alone are neither shuffled nor sorted.

    Hashes of the keys are counted first, 8 bytes a row; rows of a repeated hash, and
    so all rows of a repeated key, are grouped by key.  With more than
    ``FEW_REPEATED`` of them every row is.  ``df`` is evaluated more than once and must
    give the same rows each time.
    """
    def grouped(rows):
        return latest_per_key(rows, keys, order_by) if order_by else rows.dropDuplicates(keys)

    name = F.xxhash64(*keys)
    repeated = stored(df.groupBy(name.alias("_h")).agg(F.count(F.lit(1)).alias("_n"))
                      .filter(F.col("_n") > 1).select("_h"), "repeated-keys")
    n = repeated.count()
    if n == 0:
        return df
    if n > FEW_REPEATED:
        return grouped(df)
    marked = df.withColumn("_h", name).join(repeated.withColumn("_again", F.lit(True)), "_h", "left")
    alone = marked.filter(F.col("_again").isNull()).select(*df.columns)
    return alone.unionByName(grouped(marked.filter(F.col("_again").isNotNull()).select(*df.columns)))
