"""Cursor scans over landed feeds.

Every scan is a filter on the cursor column plus an ordered limit, so the
cursor predicate reaches the Parquet reader (``PushedFilters``) and row
groups below the cursor are skipped.  The cursor is the pair
``(cursor, key)`` by default: a strict ``>`` on the time alone loses rows
that tie at the cut of a limited batch (Q16); ``literal=True`` restores it.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import ts_lit
from ..operators.ids import assign_dense_ids


def _after(cursor_col: str, key_col: str | None, after, after_key, literal: bool):
    if after is None:
        return None
    c = F.col(cursor_col)
    v = ts_lit(after) if isinstance(after, (_dt.date, _dt.datetime)) else F.lit(after)
    if literal or key_col is None or after_key is None:
        return c > v
    return (c > v) | ((c == v) & (F.col(key_col) > F.lit(after_key)))


def scan_cursor(df: DataFrame, cursor_col: str, key_col: str | None = None, after=None,
                after_key=None, limit: int | None = None, literal: bool = False,
                ordered: bool | None = None) -> DataFrame:
    """Rows past the cursor, at most ``limit`` in ``(cursor, key)`` order.

    With a limit the order decides which rows form the batch (a top-k, no
    global sort); without one the batch is every row past the cursor and is
    left unsorted (set-based consumers need no order) unless ``ordered``.
    """
    cond = _after(cursor_col, key_col, after, after_key, literal)
    out = df if cond is None else df.filter(cond)
    order = [cursor_col] + ([key_col] if key_col and key_col != cursor_col else [])
    if limit is not None:
        return out.orderBy(*order).limit(limit)
    return out.orderBy(*order) if ordered else out


def scan_cursor_ts(df: DataFrame, ts_col: str = "update_ts", key_col: str = "object_id",
                   after=None, after_key=None, limit: int | None = None,
                   literal: bool = False) -> DataFrame:
    """Document scan by update time."""
    return scan_cursor(df, ts_col, key_col, after, after_key, limit, literal)


def scan_cursor_id(df: DataFrame, id_col: str = "id", after: int | None = None,
                   limit: int | None = None) -> DataFrame:
    """Relational scan by increasing id."""
    return scan_cursor(df, id_col, None, after, None, limit)


def scan_cursor_typed(df: DataFrame, id_col: str, type_col: str, type_value: str,
                      after: int | None = None, limit: int | None = None) -> DataFrame:
    """Id-cursor scan of one event type."""
    return scan_cursor(df.filter(F.col(type_col) == F.lit(type_value)), id_col, None,
                       after, None, limit)


def scan_offset_page(df: DataFrame, sort_cols: list[str], offset: int, limit: int) -> DataFrame:
    """Rows ``offset+1 .. offset+limit`` in ``sort_cols`` order.

    ``sort_cols`` must end with a unique key so pages do not overlap.  Rows are
    numbered by a distributed sort at every depth; only the page is sorted whole.
    """
    ranked = assign_dense_ids(df, sort_cols, id_col="_rank")
    page = ranked.filter((F.col("_rank") > offset) & (F.col("_rank") <= offset + limit))
    return page.orderBy("_rank").drop("_rank")


def batch_bookmark(batch: DataFrame, cursor_col: str, key_col: str | None = None) -> DataFrame:
    """New bookmark of a scanned batch (S20): last cursor value, last key at
    that value, and the batch size, in one aggregate job."""
    aggs = [F.max(cursor_col).alias("last_cursor"), F.count(F.lit(1)).alias("batch_rows")]
    if key_col:
        aggs.append(F.max_by(F.col(key_col), F.struct(F.col(cursor_col), F.col(key_col)))
                    .alias("last_key"))
    else:
        aggs.append(F.lit(None).alias("last_key"))
    return batch.agg(*aggs)
