"""Pending rows whose parent is not loaded yet.

A fact that references an unknown order or product is neither dropped nor
given a zero id: it is kept in a pending set and joined again on the next
run, after the parents may have arrived.  Both outputs come from one
left join (an indicator column), not from two passes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def resolve(rows: DataFrame, parent: DataFrame, row_key: str, parent_key: str,
            parent_id: str, out_col: str, pending: DataFrame | None = None,
            kept: Callable[[DataFrame, str], DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """Attach ``parent_id`` as ``out_col``; return ``(resolved, still_pending)``.

    ``pending`` (rows left over by an earlier run, same columns as ``rows``)
    is retried together with the new rows.  ``kept`` stores the joined rows, so that
    two outputs that are both written come from one join.
    """
    src = rows if pending is None else rows.unionByName(pending)
    p = parent.select(F.col(parent_key).alias("_pk"), F.col(parent_id).alias(out_col))
    joined = src.join(p, src[row_key] == p["_pk"], "left").drop("_pk")
    joined = joined if kept is None else kept(joined, f"met-{out_col}")
    resolved = joined.filter(F.col(out_col).isNotNull())
    waiting = joined.filter(F.col(out_col).isNull()).drop(out_col)
    return resolved, waiting
