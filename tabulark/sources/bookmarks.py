"""Load bookmarks (S18-S20): workflow key -> JSON settings.

The bookmark table is a small ``(workflow_key, workflow_settings)`` table;
reads parse the JSON on the executors, saves are an upsert by key, and a
batch's new bookmark is one aggregate over the scanned batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sinks import merge_upsert

# Start bookmark of each workflow family and how it advances.
START_TS = "2022-01-01 00:00:00"   # order-system feeds: max(update_ts), to the second
START_ID = -1                      # bonus feeds and dds builds: max(id)
START_OFFSET = 0                   # courier-service pages: offset + count


def read_setting(bookmarks: DataFrame, field: str, default=None,
                 keys: DataFrame | None = None) -> DataFrame:
    """Value of ``field`` in each workflow's settings (default when absent).

    With ``keys`` (a one-column ``workflow_key`` frame) every requested key
    gets a row, absent keys the default.
    """
    value = F.get_json_object(F.col("workflow_settings"), f"$.{field}")
    b = bookmarks.select("workflow_key", value.alias("value"))
    if keys is not None:
        b = keys.join(b, "workflow_key", "left")
    if default is not None:
        b = b.withColumn("value", F.coalesce(F.col("value"), F.lit(str(default))))
    return b


def save_settings(bookmarks: DataFrame | None, updates: DataFrame) -> DataFrame:
    """Upsert ``(workflow_key, workflow_settings)`` rows by key."""
    return merge_upsert(bookmarks, updates, ["workflow_key"])


def settings_json(**fields: Column) -> Column:
    return F.to_json(F.struct(*[c.alias(k) for k, c in sorted(fields.items())]))


def advance_max(batch: DataFrame, cursor_col: str, field: str, previous=None,
                by: Column | None = None) -> DataFrame:
    """Bookmark after a batch: ``max(cursor)``; the previous value if empty.
    With ``by`` (a column named workflow_key) one bookmark per workflow."""
    m = F.max(F.col(cursor_col))
    if previous is not None:
        m = F.coalesce(m, F.lit(previous))
    groups = batch.groupBy(by) if by is not None else batch.groupBy()
    return groups.agg(m.alias(field), F.count(F.lit(1)).alias("batch_rows"))


def advance_offset(batch: DataFrame, previous: int = START_OFFSET, field: str = "offset") -> DataFrame:
    """Paged feeds: ``previous + rows in the batch``."""
    return batch.agg((F.lit(previous) + F.count(F.lit(1))).alias(field),
                     F.count(F.lit(1)).alias("batch_rows"))
