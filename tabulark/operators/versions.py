"""Version history (close-and-open, Q15) without a per-key window.

``lead(active_from) over (partition by key order by active_from)`` would
send every version of a key to one task.  Here the rows are range-
partitioned on (key, time) instead, so a key with very many versions spans
several tasks:

1. range-partition and sort on (key, time); tag each row with its range
   partition ``_p`` and position ``_l``; write once (lineage cut);
2. the next row inside a partition comes from a window over ``_p`` (range
   partitions are balanced, so no task is hot);
3. the last row of a partition takes the first row of the next non-empty
   partition: one row per partition reaches the driver;
4. a version ends where the next row of the same key begins, else it stays
   open.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import OPEN_END, ts_lit
from .ids import range_tagged


def close_versions(df: DataFrame, key: str, start_col: str, end_col: str = "active_to",
                   open_end: Column | None = None, num_partitions: int | None = None,
                   same: list[str] | None = None) -> DataFrame:
    """Add ``end_col``: the next version's ``start_col`` for the same key, or open.

    With ``same``, a version equal in these columns to the one before it is no
    change and goes first (the first of equal neighbours stays)."""
    if same:
        df = _changes(df, key, start_col, same, num_partitions)
    fixed = range_tagged(df, [key, start_col], num_partitions, name="versions")

    firsts = (fixed.groupBy("_p")
              .agg(F.min_by(F.struct(F.col(key).alias("k"), F.col(start_col).alias("t")), F.col("_l"))
                   .alias("first")).collect())
    first_of = {int(r["_p"]): (r["first"]["k"], r["first"]["t"]) for r in firsts}
    ordered = sorted(first_of)
    follow_k, follow_t = {}, {}
    for i, p in enumerate(ordered[:-1]):
        follow_k[p], follow_t[p] = first_of[ordered[i + 1]]

    w = Window.partitionBy("_p").orderBy("_l")
    nk = F.lead(F.col(key)).over(w)
    nt = F.lead(F.col(start_col)).over(w)

    def _lookup(m: dict, dtype: str) -> Column:
        if not m:
            return F.lit(None).cast(dtype)
        pairs = []
        for p, v in m.items():
            pairs += [F.lit(p), F.lit(v).cast(dtype)]
        return F.element_at(F.create_map(*pairs), F.col("_p"))

    key_type = dict(fixed.dtypes)[key]
    ts_type = dict(fixed.dtypes)[start_col]
    next_k = F.coalesce(nk, _lookup(follow_k, key_type))
    next_t = F.when(nk.isNotNull(), nt).otherwise(_lookup(follow_t, ts_type))
    end = open_end if open_end is not None else ts_lit(OPEN_END)
    out = fixed.withColumn(end_col, F.when(next_k == F.col(key), next_t).otherwise(end))
    return out.drop("_p", "_l")


def _changes(df: DataFrame, key: str, start_col: str, same: list[str],
             num_partitions: int | None) -> DataFrame:
    """Rows that differ in ``same`` from the row before them, per key by time."""
    fixed = range_tagged(df, [key, start_col], num_partitions, name="changes")
    state = F.struct(F.col(key).alias("k"), *[F.col(c) for c in same])
    lasts = {int(r["_p"]): r["last"] for r in fixed.groupBy("_p").agg(
        F.max_by(F.xxhash64(state), F.col("_l")).alias("last")).collect()}
    # The last state of the range partition before, one number each.
    before, order = [], sorted(lasts)
    for p, q in zip(order, order[1:]):
        before.append((q, lasts[p]))
    edges = fixed.sparkSession.createDataFrame(before, "_p int, _edge long")
    w = Window.partitionBy("_p").orderBy("_l")
    told = fixed.withColumn("_state", F.xxhash64(state)).join(F.broadcast(edges), "_p", "left")
    told = told.withColumn("_prior", F.coalesce(F.lag("_state").over(w), F.col("_edge")))
    return told.filter(F.col("_prior").isNull() | (F.col("_prior") != F.col("_state"))).select(*df.columns)
