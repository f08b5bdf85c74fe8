"""Registered operator queries: scans, sinks, bookmarks, functions, JSON,
checks, pending, quarantine, stream ingest and the literal minute join.

Inputs that an operator needs in a particular shape (two overlapping
batches, a partly loaded parent, malformed text) are derived by Spark from
the driver's whole tables, by date cut-offs or by the row's own type, so
every query still processes every row.
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import oracle_sql as O
from .catalog import DAY, MONTH, dds, register
from .functions import dates as D
from .functions.json_ops import canonical_json, field, parse
from .operators import checks
from .operators.dedupe import latest_per_key
from .operators.quarantine import split_parsed
from .plans import dims, facts, marts
from .plans.dds import materialized_stg
from .plans.incremental import FEEDS, Staging, Warehouse, run_dds, run_stg
from .plans.refresh import refresh_marts
from .session import configure, scratch_path
from .sources import adapters, bookmarks, scans
from .sources.driver import Tables
from .sources.sinks import Table, sink_append, sink_insert_ignore, sink_upsert
from .streaming.ingest import ingest_landed
from pyspark.sql import types as T

# Fixed parameters of the operator queries (cursor positions, batch sizes,
# cut-offs between two loads).  Batch sizes are the source system's.
DOC_BATCH = 10_000
EVENT_BATCH = 1_000
PAGE_SIZE = 200
PAGE_OFFSET = 400
TS_CURSOR = _dt.datetime(2024, 1, 15, 12, 0, 0)
ID_CURSOR = 4_999
TYPED_ID_CURSOR = 999
TYPED_EVENT = "purchase"
# Two overlapping loads of orders: the first up to 1998, the second from 1997.
FIRST_LOAD_END = _dt.date(1998, 1, 1)
SECOND_LOAD_START = _dt.date(1997, 1, 1)
# Two overlapping drops of events.
EVENTS_FIRST_END = _dt.datetime(2024, 1, 20)
EVENTS_SECOND_START = _dt.datetime(2024, 1, 10)
# Every so many orders' sales arrive late.
LATE_SALES = 50
# Orders loaded before the deliveries arrive (late-parent scenario).
PARENT_LOADED_END = _dt.date(1998, 1, 1)


def _t(spark, sf_dir) -> Tables:
    configure(spark)
    return Tables(spark, sf_dir)


# --- scans ------------------------------------------------------------------------

@register("scan_cursor_ts", f"""
SELECT * FROM events
WHERE ts > TIMESTAMP '{TS_CURSOR}'
ORDER BY ts, event_id LIMIT {DOC_BATCH}""")
def q_scan_cursor_ts(spark, sf_dir):
    return scans.scan_cursor_ts(_t(spark, sf_dir).events, "ts", "event_id", after=TS_CURSOR,
                                limit=DOC_BATCH)


@register("scan_cursor_id", f"""
SELECT * FROM orders WHERE o_orderkey > {ID_CURSOR} ORDER BY o_orderkey LIMIT {DOC_BATCH}""")
def q_scan_cursor_id(spark, sf_dir):
    return scans.scan_cursor_id(_t(spark, sf_dir).orders, "o_orderkey", after=ID_CURSOR,
                                limit=DOC_BATCH)


@register("scan_cursor_typed", f"""
SELECT * FROM events WHERE event_type = '{TYPED_EVENT}' AND event_id > {TYPED_ID_CURSOR}
ORDER BY event_id LIMIT {EVENT_BATCH}""")
def q_scan_cursor_typed(spark, sf_dir):
    return scans.scan_cursor_typed(_t(spark, sf_dir).events, "event_id", "event_type",
                                   TYPED_EVENT, after=TYPED_ID_CURSOR, limit=EVENT_BATCH)


@register("scan_offset_page", f"""
SELECT * FROM customer ORDER BY c_custkey LIMIT {PAGE_SIZE} OFFSET {PAGE_OFFSET}""")
def q_scan_offset_page(spark, sf_dir):
    return scans.scan_offset_page(_t(spark, sf_dir).customer, ["c_custkey"], PAGE_OFFSET, PAGE_SIZE)


# --- dedupe -----------------------------------------------------------------------

_LI_REST = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
            "l_returnflag", "l_linestatus"]


@register("dedupe_latest", f"""
SELECT * FROM lineitem
QUALIFY row_number() OVER (
  PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_shipdate DESC, {', '.join(c + ' DESC' for c in _LI_REST)}) = 1""")
def q_dedupe_latest(spark, sf_dir):
    li = _t(spark, sf_dir).lineitem
    return latest_per_key(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


# --- load batches derived from the driver's tables -----------------------------------

def _orders_first(t: Tables) -> DataFrame:
    o = t.orders
    return o.filter(F.col("o_orderdate") < D.ts_lit(FIRST_LOAD_END)).select(
        "o_orderkey", "o_custkey", "o_orderstatus",
        F.col("o_totalprice").cast("decimal(19,2)").alias("o_totalprice"),
        "o_orderdate", F.col("o_orderdate").alias("update_ts"))


def _orders_second(t: Tables) -> DataFrame:
    """The second load: the same orders from 1997 on, now final and repriced."""
    o = t.orders
    return o.filter(F.col("o_orderdate") >= D.ts_lit(SECOND_LOAD_START)).select(
        "o_orderkey", "o_custkey", F.lit("F").alias("o_orderstatus"),
        (F.col("o_totalprice").cast("decimal(19,2)") + F.lit(1)).cast("decimal(19,2)")
        .alias("o_totalprice"),
        "o_orderdate", (F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("update_ts"))


_B1 = f"""b1 AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(19,2)) AS o_totalprice,
         o_orderdate, o_orderdate AS update_ts
  FROM orders WHERE o_orderdate < DATE '{FIRST_LOAD_END}')"""
_B2 = f"""b2 AS (
  SELECT o_orderkey, o_custkey, 'F' AS o_orderstatus,
         CAST(CAST(o_totalprice AS DECIMAL(19,2)) + 1 AS DECIMAL(19,2)) AS o_totalprice,
         o_orderdate, o_orderdate + INTERVAL 1 DAY AS update_ts
  FROM orders WHERE o_orderdate >= DATE '{SECOND_LOAD_START}')"""


def _table(spark, name) -> Table:
    return Table(spark, scratch_path(spark, name))


@register("sink_append", O.with_(_B1, _B2) + "SELECT * FROM b1 UNION ALL SELECT * FROM b2")
def q_sink_append(spark, sf_dir):
    t = _t(spark, sf_dir)
    table = _table(spark, "sink-append")
    sink_append(table, _orders_first(t))
    return sink_append(table, _orders_second(t))


@register("sink_upsert_key", O.with_(_B1, _B2) + """,
t1 AS (SELECT row_number() OVER (ORDER BY o_orderkey) AS id, * FROM b1),
fresh AS (
  SELECT (SELECT max(id) FROM t1) + row_number() OVER (ORDER BY o_orderkey) AS id, b2.*
  FROM b2 WHERE o_orderkey NOT IN (SELECT o_orderkey FROM b1))
SELECT * FROM t1 WHERE o_orderkey NOT IN (SELECT o_orderkey FROM b2)
UNION ALL
SELECT t1.id, b2.* FROM b2 JOIN t1 ON t1.o_orderkey = b2.o_orderkey
UNION ALL
SELECT * FROM fresh""")
def q_sink_upsert_key(spark, sf_dir):
    """Upsert by business key; existing surrogate ids kept, new keys numbered after."""
    t = _t(spark, sf_dir)
    table = _table(spark, "sink-upsert-key")
    sink_upsert(table, _orders_first(t), ["o_orderkey"], ["update_ts"], id_col="id")
    return sink_upsert(table, _orders_second(t), ["o_orderkey"], ["update_ts"], id_col="id")


_E1 = f"""e1 AS (
  SELECT event_id AS id, ts AS event_ts, event_type, props AS event_value,
         CAST(value AS DECIMAL(19,2)) AS value
  FROM events WHERE ts < TIMESTAMP '{EVENTS_FIRST_END}')"""
_E2 = f"""e2 AS (
  SELECT event_id AS id, ts AS event_ts, event_type, props AS event_value,
         CAST(CAST(value AS DECIMAL(19,2)) + 1 AS DECIMAL(19,2)) AS value
  FROM events WHERE ts >= TIMESTAMP '{EVENTS_SECOND_START}')"""


def _events_first(t: Tables) -> DataFrame:
    return t.events.filter(F.col("ts") < D.ts_lit(EVENTS_FIRST_END)).select(
        F.col("event_id").alias("id"), F.col("ts").alias("event_ts"), "event_type",
        F.col("props").alias("event_value"), F.col("value").cast("decimal(19,2)").alias("value"))


def _events_second(t: Tables) -> DataFrame:
    return t.events.filter(F.col("ts") >= D.ts_lit(EVENTS_SECOND_START)).select(
        F.col("event_id").alias("id"), F.col("ts").alias("event_ts"), "event_type",
        F.col("props").alias("event_value"),
        (F.col("value").cast("decimal(19,2)") + F.lit(1)).cast("decimal(19,2)").alias("value"))


@register("sink_upsert_id", O.with_(_E1, _E2) + """
SELECT * FROM e1 WHERE id NOT IN (SELECT id FROM e2)
UNION ALL SELECT * FROM e2""")
def q_sink_upsert_id(spark, sf_dir):
    """Upsert by source id (outbox events, ranks, bonus users)."""
    t = _t(spark, sf_dir)
    table = _table(spark, "sink-upsert-id")
    sink_upsert(table, _events_first(t), ["id"])
    return sink_upsert(table, _events_second(t), ["id"])


@register("sink_insert_ignore", O.with_(_B1, _B2) + """
SELECT * FROM b1
UNION ALL SELECT * FROM b2 WHERE o_orderkey NOT IN (SELECT o_orderkey FROM b1)""")
def q_sink_insert_ignore(spark, sf_dir):
    t = _t(spark, sf_dir)
    table = _table(spark, "sink-insert-ignore")
    sink_insert_ignore(table, _orders_first(t), ["o_orderkey"])
    return sink_insert_ignore(table, _orders_second(t), ["o_orderkey"])


def _read_back(spark, path, like: DataFrame) -> DataFrame:
    return spark.read.schema(like.schema).parquet(path).select(*like.columns)


@register("sink_replace_day", f"""
SELECT * FROM ({O.settlement(f"AND CAST(o.o_orderdate AS DATE) <> DATE '{DAY}'")})
UNION ALL
SELECT * FROM ({O.settlement(f"AND CAST(o.o_orderdate AS DATE) = DATE '{DAY}'",
                             natural_id=True, count_orders=True)})""")
def q_sink_replace_day(spark, sf_dir):
    """Daily mart written for all days, then one day rewritten (other days untouched)."""
    t = dds(spark, sf_dir)
    args = (t["fct_product_sales"], t["dm_orders"], t["dm_restaurants"], t["dm_timestamps"])
    path = scratch_path(spark, "cdm-settlement")
    full = marts.settlement_report(*args, ordered=False)
    marts.publish_settlement(full, path)
    again = marts.settlement_report(*args, first_day=DAY, natural_restaurant_id=True,
                                    count_orders=True, ordered=False)
    marts.publish_settlement(again, path, first_day=DAY, clear_if_empty=True)
    return _read_back(spark, path, full)


_MONTH_SQL = (f"d.order_ts >= DATE '{MONTH}' AND d.order_ts < DATE '{MONTH}' + INTERVAL 1 MONTH")


@register("sink_replace_month", f"""
SELECT * FROM ({O.ledger(f"AND NOT ({_MONTH_SQL})")})
UNION ALL
SELECT * FROM ({O.ledger(f"AND {_MONTH_SQL}", per_order=True)})""")
def q_sink_replace_month(spark, sf_dir):
    """Monthly ledger written for all months, then one month rewritten."""
    t = dds(spark, sf_dir)
    path = scratch_path(spark, "cdm-ledger")
    full = marts.courier_ledger(t["fct_deliveries"], t["dm_couriers"], ordered=False)
    marts.publish_ledger(full, path)
    again = marts.courier_ledger_per_order(t["fct_deliveries"], t["dm_couriers"],
                                           first_month=MONTH, ordered=False)
    marts.publish_ledger(again, path, first_month=MONTH, clear_if_empty=True)
    return _read_back(spark, path, full)


# --- bookmarks ------------------------------------------------------------------------

@register("bookmark_advance", f"""
SELECT 'events_' || event_type AS workflow_key, CAST(max(event_id) AS VARCHAR) AS value,
       count(*) AS batch_rows
FROM events GROUP BY event_type
UNION ALL
SELECT 'orders_documents', strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S'), count(*) FROM orders
UNION ALL
SELECT 'courier_pages', CAST({PAGE_OFFSET} + count(*) AS VARCHAR), count(*)
FROM (SELECT * FROM customer ORDER BY c_custkey LIMIT {PAGE_SIZE} OFFSET {PAGE_OFFSET})""")
def q_bookmark_advance(spark, sf_dir):
    """New bookmarks by all three rules: ``max(id)`` per outbox workflow,
    ``max(update time)`` of documents, offset plus rows of a page."""
    t = _t(spark, sf_dir)
    ev = scans.scan_cursor_id(t.events, "event_id", after=bookmarks.START_ID)
    ids = bookmarks.advance_max(ev, "event_id", "value", by=F.concat(
        F.lit("events_"), F.col("event_type")).alias("workflow_key"))
    docs = scans.scan_cursor(t.orders, "o_orderdate", "o_orderkey", ordered=False)
    times = bookmarks.advance_max(docs, "o_orderdate", "value")
    page = scans.scan_offset_page(t.customer, ["c_custkey"], PAGE_OFFSET, PAGE_SIZE)
    offset = bookmarks.advance_offset(page, PAGE_OFFSET, "value")
    return (ids.select("workflow_key", F.col("value").cast("string").alias("value"), "batch_rows")
            .unionByName(times.select(F.lit("orders_documents").alias("workflow_key"),
                                      F.date_format("value", D.DATETIME_FORMAT).alias("value"), "batch_rows"))
            .unionByName(offset.select(F.lit("courier_pages").alias("workflow_key"),
                                       F.col("value").cast("string").alias("value"), "batch_rows")))


def _bookmark_rows(df: DataFrame) -> DataFrame:
    return df.select(F.concat(F.lit("wf-"), F.col("event_id").cast("string")).alias("workflow_key"),
                     F.col("props").alias("workflow_settings"))


@register("bookmark_read", """
SELECT 'wf-' || CAST(event_id AS VARCHAR) AS workflow_key, json_extract_string(props, '$.k') AS value
FROM events""")
def q_bookmark_read(spark, sf_dir):
    return bookmarks.read_setting(_bookmark_rows(_t(spark, sf_dir).events), "k")


@register("bookmark_save", f"""
WITH s1 AS (SELECT 'wf-' || CAST(event_id AS VARCHAR) AS workflow_key, props AS workflow_settings
            FROM events WHERE ts < TIMESTAMP '{EVENTS_FIRST_END}'),
s2 AS (SELECT 'wf-' || CAST(event_id AS VARCHAR) AS workflow_key,
              '{{"k":' || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) + 1 AS VARCHAR) || '}}'
                AS workflow_settings
       FROM events WHERE ts >= TIMESTAMP '{EVENTS_SECOND_START}')
SELECT * FROM s1 WHERE workflow_key NOT IN (SELECT workflow_key FROM s2)
UNION ALL SELECT * FROM s2""")
def q_bookmark_save(spark, sf_dir):
    """Bookmarks saved twice: the second save advances every workflow it names."""
    ev = _t(spark, sf_dir).events
    first = _bookmark_rows(ev.filter(F.col("ts") < D.ts_lit(EVENTS_FIRST_END)))
    later = ev.filter(F.col("ts") >= D.ts_lit(EVENTS_SECOND_START))
    second = later.select(
        F.concat(F.lit("wf-"), F.col("event_id").cast("string")).alias("workflow_key"),
        bookmarks.settings_json(k=parse("props", T.StructType([T.StructField("k", T.IntegerType())]))
                                .getField("k") + F.lit(1)).alias("workflow_settings"))
    table = _table(spark, "bookmarks")
    table.replace(bookmarks.save_settings(None, first))
    table.replace(bookmarks.save_settings(table.read(), second))
    return table.read()


# --- scalar functions --------------------------------------------------------------------

@register("fn_date_trunc", """
SELECT event_id, CAST(date_trunc('minute', ts) AS TIMESTAMP) AS ts_minute,
       CAST(date_trunc('hour', ts) AS TIMESTAMP) AS ts_hour,
       CAST(date_trunc('day', ts) AS TIMESTAMP) AS ts_day,
       CAST(date_trunc('month', ts) AS TIMESTAMP) AS ts_month
FROM events""")
def q_fn_date_trunc(spark, sf_dir):
    return _t(spark, sf_dir).events.select(
        "event_id", D.trunc_ts("minute", "ts").alias("ts_minute"),
        D.trunc_ts("hour", "ts").alias("ts_hour"), D.trunc_ts("day", "ts").alias("ts_day"),
        D.trunc_ts("month", "ts").alias("ts_month"))


@register("fn_extract", """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS order_year,
       CAST(month(o_orderdate) AS INTEGER) AS order_month,
       CAST(day(o_orderdate) AS INTEGER) AS order_day
FROM orders""")
def q_fn_extract(spark, sf_dir):
    o = _t(spark, sf_dir).orders
    return o.select("o_orderkey", F.year("o_orderdate").alias("order_year"),
                    F.month("o_orderdate").alias("order_month"),
                    F.dayofmonth("o_orderdate").alias("order_day"))


@register("fn_cast_date", """
SELECT o_orderkey,
       CAST(CAST(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS DATE) AS order_date
FROM orders""")
def q_fn_cast_date(spark, sf_dir):
    """Calendar text -> timestamp -> date (``ts_date::timestamp::date``)."""
    o = _t(spark, sf_dir).orders
    text = D.format_ts("o_orderdate")
    return o.select("o_orderkey", F.to_date(D.parse_ts(text)).alias("order_date"))


@register("fn_parse_ts", """
SELECT event_id,
       try_strptime(CASE WHEN event_type = 'error' THEN 'not a time'
                         ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END, '%Y-%m-%d %H:%M:%S') AS parsed
FROM events""")
def q_fn_parse_ts(spark, sf_dir):
    """Source text to timestamp; bad text (here: every error event) gives null."""
    ev = _t(spark, sf_dir).events
    text = F.when(F.col("event_type") == "error", F.lit("not a time")).otherwise(D.format_ts("ts"))
    return ev.select("event_id", D.parse_ts(text).alias("parsed"))


@register("fn_format_ts", """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS ts_date, strftime(ts, '%H:%M:%S') AS ts_time,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text
FROM events""")
def q_fn_format_ts(spark, sf_dir):
    ev = _t(spark, sf_dir).events
    return ev.select("event_id", D.format_ts("ts", D.DATE_FORMAT).alias("ts_date"),
                     D.format_ts("ts", D.TIME_FORMAT).alias("ts_time"),
                     D.format_ts("ts").alias("ts_text"))


# --- JSON -------------------------------------------------------------------------------

_K = T.StructType([T.StructField("k", T.IntegerType())])


@register("json_fields", """
SELECT event_id, json_extract_string(props, '$.k') AS k_text,
       CAST(json_extract(props, '$.k') AS INTEGER) AS k
FROM events""")
def q_json_fields(spark, sf_dir):
    ev = _t(spark, sf_dir).events
    return ev.select("event_id", field("props", "$.k").alias("k_text"),
                     parse("props", _K).getField("k").alias("k"))


@register("json_canonical", """
SELECT o_orderkey, o_orderstatus, o_orderdate, CAST(o_totalprice AS DECIMAL(19,2)) AS o_totalprice,
       CAST(o_custkey AS VARCHAR) AS user_id, TRUE AS keys_sorted
FROM orders""")
def q_json_canonical(spark, sf_dir):
    """Row -> canonical JSON text (sorted keys, second-precision times) -> fields again."""
    o = _t(spark, sf_dir).orders.select(
        "o_totalprice", "o_orderstatus", "o_orderkey", "o_orderdate",
        F.struct(F.col("o_custkey").cast("string").alias("id")).alias("user"))
    o = o.withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(19,2)"))
    text = canonical_json(o)
    schema = T.StructType([T.StructField("o_orderkey", T.LongType()),
                           T.StructField("o_orderstatus", T.StringType()),
                           T.StructField("o_orderdate", T.StringType()),
                           T.StructField("o_totalprice", T.DecimalType(19, 2)),
                           T.StructField("user", T.StructType([T.StructField("id", T.StringType())]))])
    parsed = o.select(text.alias("doc")).select("doc", F.from_json("doc", schema).alias("v"))
    keys = F.json_object_keys("doc")
    return parsed.select("v.o_orderkey", "v.o_orderstatus",
                         D.parse_ts("v.o_orderdate").alias("o_orderdate"), "v.o_totalprice",
                         F.col("v.user.id").alias("user_id"),
                         (F.array_sort(keys) == keys).alias("keys_sorted"))


# --- integrity checks -----------------------------------------------------------------------

@register("check_unique", """
SELECT l_orderkey, l_linenumber, count(*) AS dup_count
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def q_check_unique(spark, sf_dir):
    return checks.check_unique(_t(spark, sf_dir).lineitem, ["l_orderkey", "l_linenumber"])


@register("check_not_null", O.with_(O.REST, O.USERS, O.ORDER_KEYS, O.CALENDAR, O.DM_ORDERS) + """
SELECT order_key, 'timestamp_id' AS null_column FROM dmo WHERE tid IS NULL""")
def q_check_not_null(spark, sf_dir):
    """Orders without a calendar entry (still in delivery on a day with no
    closed order) have a null ``timestamp_id``."""
    o = dds(spark, sf_dir)["dm_orders"]
    return checks.check_not_null(o, ["restaurant_id", "timestamp_id", "user_id"], key=["order_key"])


@register("check_foreign_key", O.with_(O.DELIV, O.ORDER_KEYS) + f"""
SELECT d.delivery_id, d.order_key FROM deliv d
WHERE d.order_key NOT IN (SELECT order_key FROM okeys WHERE o_orderdate < DATE '{PARENT_LOADED_END}')""")
def q_check_foreign_key(spark, sf_dir):
    """Deliveries whose order is not among the orders loaded so far."""
    t = _t(spark, sf_dir)
    loaded = adapters.order_documents(t).filter(F.col("update_ts") < D.ts_lit(PARENT_LOADED_END))
    child = adapters.delivery_pages(t).select("delivery_id", F.col("order_id").alias("order_key"))
    return checks.check_foreign_key(child, loaded, ["order_key"], ["object_id"])


@register("check_range", """
SELECT c_custkey, c_acctbal FROM customer WHERE NOT (c_acctbal >= 0)""")
def q_check_range(spark, sf_dir):
    c = _t(spark, sf_dir).customer.select("c_custkey", "c_acctbal")
    return checks.check_range(c, F.col("c_acctbal") >= 0)


# --- pending, quarantine --------------------------------------------------------------------

@register("pending_orphans", O.with_(O.DELIV, O.ORDER_KEYS) + f"""
SELECT d.delivery_id, d.order_key FROM deliv d
WHERE d.order_key NOT IN (SELECT order_key FROM okeys WHERE o_orderdate < DATE '{PARENT_LOADED_END}')""")
def q_pending_orphans(spark, sf_dir):
    """Deliveries loaded while only the orders before the cut-off are in dds:
    the rest wait as pending (D9) instead of being lost."""
    d = dds(spark, sf_dir)
    stg = materialized_stg(spark, sf_dir)
    docs = stg["orders"].filter(F.col("update_ts") < D.ts_lit(PARENT_LOADED_END))
    orders = dims.dim_orders(docs, d["dm_restaurants"], d["dm_timestamps"], d["dm_users"]).table
    built = facts.fct_deliveries(stg["deliveries"], orders, d["dm_couriers"])
    return built.pending.select("delivery_id", "order_key")


@register("quarantine_bad", """
SELECT event_id, CASE event_type WHEN 'error' THEN 'not json' ELSE 'missing k' END AS reason
FROM events WHERE event_type IN ('error', 'signup')""")
def q_quarantine_bad(spark, sf_dir):
    """Outbox bodies after a format change: error events arrive cut short, signup
    events with a renamed field.  Both are quarantined, the batch completes."""
    ev = _t(spark, sf_dir).events
    body = (F.when(F.col("event_type") == "error", F.expr("substring(props, 1, length(props) - 1)"))
            .when(F.col("event_type") == "signup", F.regexp_replace("props", '"k"', '"j"'))
            .otherwise(F.col("props")))
    _good, bad = split_parsed(ev.withColumn("props", body), "props", _K, ["k"])
    return bad.select("event_id", "reason")


# --- stream ingest -----------------------------------------------------------------------------

_STREAM_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("event_ts", T.TimestampNTZType()),
    T.StructField("event_type", T.StringType()), T.StructField("event_value", T.StringType()),
    T.StructField("value", T.DecimalType(19, 2)), T.StructField("update_ts", T.TimestampNTZType())])


@register("stream_ingest_upsert", O.with_(_E1, _E2) + """
SELECT *, event_ts AS update_ts FROM e1 WHERE id NOT IN (SELECT id FROM e2)
UNION ALL SELECT *, event_ts + INTERVAL 1 DAY AS update_ts FROM e2""")
def q_stream_ingest_upsert(spark, sf_dir):
    """Two landed JSON drops of outbox rows, ingested by a file stream with
    ``availableNow`` and upserted per micro-batch (latest ``update_ts`` wins)."""
    t = _t(spark, sf_dir)
    landing = scratch_path(spark, "landing")
    first = _events_first(t).withColumn("update_ts", F.col("event_ts"))
    second = _events_second(t).withColumn("update_ts", F.col("event_ts") + F.expr("INTERVAL 1 DAY"))
    opts = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    first.write.options(**opts).json(f"{landing}/drop-1")
    second.write.options(**opts).json(f"{landing}/drop-2")
    table = _table(spark, "stream-target")
    return ingest_landed(spark, f"{landing}/drop-*", _STREAM_SCHEMA, table, ["id"], ["update_ts"],
                         checkpoint=scratch_path(spark, "stream-ckpt"), files_per_batch=1,
                         options=opts)


# --- literal minute join ---------------------------------------------------------------------

@register("courier_ledger_minute_join", O._tiered("""
WITH d AS (SELECT user_id AS courier_id, ts AS order_ts, CAST(value AS DECIMAL(19,5)) AS dsum,
                  CAST(CAST(value AS DECIMAL(19,5)) * 0.1 AS DECIMAL(19,5)) AS tip,
                  CAST(1 + event_id % 5 AS INTEGER) AS rate
           FROM events),
cal AS (SELECT DISTINCT ts, year(ts) AS ts_year, month(ts) AS ts_month FROM events),
g AS (
  SELECT d.courier_id, c.c_name AS courier_name, cal.ts_year AS y, cal.ts_month AS m,
         count(d.courier_id) AS n, sum(d.rate * 10) AS rate10, sum(d.dsum) AS total,
         sum(d.tip) AS tips
  FROM d
  LEFT JOIN customer c ON c.c_custkey = d.courier_id
  LEFT JOIN cal ON date_trunc('minute', d.order_ts) = date_trunc('minute', cal.ts)
  GROUP BY 1, 2, 3, 4)"""))
def q_courier_ledger_minute_join(spark, sf_dir):
    """The ledger as literally written: calendar joined on the order's minute.

    Events stand in for deliveries (user = courier, value = sum) and for the
    calendar, which has minutes with several rows, so the fan-out shows."""
    t = _t(spark, sf_dir)
    ev = t.events
    money = F.col("value").cast("decimal(19,5)")
    deliveries = ev.select(F.col("user_id").alias("courier_id"), F.col("ts").alias("order_ts"),
                           (F.lit(1) + F.pmod("event_id", F.lit(5))).cast("decimal(2,1)").alias("rate"),
                           money.alias("sum"),
                           (money * F.lit(Decimal("0.1"))).cast("decimal(19,5)").alias("tip_sum"))
    couriers = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("courier_name"))
    cal = ev.select("ts").distinct().select("ts", F.year("ts").alias("ts_year"),
                                            F.month("ts").alias("ts_month"))
    return marts.courier_ledger_minute_join(deliveries, couriers, cal, ordered=False)


# --- incremental loads ----------------------------------------------------------------

# Order ids after two incremental runs: first-run orders (before the cut-off)
# numbered in key order, second-run orders numbered after them.
_INC_ORDERS = f"""k AS (
  SELECT k.order_key, k.order_status, r.rid AS restaurant_id, c.tid AS timestamp_id,
         u.uid AS user_id, k.o_orderdate < DATE '{FIRST_LOAD_END}' AS first_run
  FROM okeys k JOIN rest r ON r.s_suppkey = k.l_suppkey
  JOIN usr u ON u.c_custkey = k.o_custkey LEFT JOIN cal c ON c.ts = k.o_orderdate),
one AS (SELECT row_number() OVER (ORDER BY order_key) AS id, * FROM k WHERE first_run),
two AS (SELECT (SELECT count(*) FROM one) + row_number() OVER (ORDER BY order_key) AS id, *
        FROM k WHERE NOT first_run),
inc AS (SELECT id, order_key, order_status, restaurant_id, timestamp_id, user_id FROM one
        UNION ALL
        SELECT id, order_key, order_status, restaurant_id, timestamp_id, user_id FROM two)"""

_ORDER_TABLES = ["dm_users", "dm_restaurants", "dm_timestamps", "dm_orders"]


def _two_runs(spark, sf_dir, only: list[str] | None = None) -> Warehouse:
    """A warehouse after two incremental runs: what arrived before the cut-off
    (of the outbox, the lower half of the ids), then the rest.  Directory feeds
    arrive whole in the first run."""
    configure(spark)
    stg = materialized_stg(spark, sf_dir)
    wh = Warehouse(spark, scratch_path(spark, "dds-incremental"))
    first = stg
    if only is None or "fct_product_sales" in only:
        half = stg["events"].agg(F.max("id")).collect()[0][0] // 2
        first = stg.with_(events=stg["events"].filter(F.col("id") <= half))
    run_dds(first, wh, until=FIRST_LOAD_END, only=only)
    run_dds(stg, wh, only=only)
    return wh


@register("dds_incremental_orders", O.with_(O.REST, O.USERS, O.ORDER_KEYS, O.CALENDAR, _INC_ORDERS)
          + "SELECT * FROM inc")
def q_dds_incremental_orders(spark, sf_dir):
    """dm_orders after two incremental runs of the stg order documents (up to the
    cut-off, then the rest), with the calendar loaded the same way; ids of the
    first run are kept and the second run's orders are numbered after them."""
    wh = _two_runs(spark, sf_dir, _ORDER_TABLES)
    return wh.read("dm_orders").select("id", "order_key", "order_status", "restaurant_id",
                                       "timestamp_id", "user_id")


@register("dds_incremental_sales", O.with_(O.SALES, O.REST, O.USERS, O.ORDER_KEYS, O.CALENDAR,
                                           O.PRODUCTS, _INC_ORDERS, O.SALES_POS) + f"""
SELECT {O.EVENT_ID} AS event_id, CAST(s2.position AS INTEGER) AS position, p.pid AS product_id,
       inc.id AS order_id, s2.cnt AS count, s2.price, s2.total_sum, s2.bonus_payment, s2.bonus_grant
FROM s2
JOIN prod p ON p.p_partkey = s2.l_partkey
JOIN inc ON inc.order_key = CAST(s2.l_orderkey AS VARCHAR) || '-' || CAST(s2.l_suppkey AS VARCHAR)""")
def q_dds_incremental_sales(spark, sf_dir):
    """Product sales loaded incrementally from the outbox by id cursor.

    Run 1 takes the first half of the outbox by id while only the orders before
    the cut-off are loaded, so sales of later orders wait (instead of being
    skipped, Q10).  Run 2 loads the other orders, takes the rest of the outbox
    and retries the waiting lines.  The result is the whole fact."""
    wh = _two_runs(spark, sf_dir, [*_ORDER_TABLES, "dm_products", "fct_product_sales"])
    return wh.read("fct_product_sales").drop("order_month")


@register("dds_incremental_deliveries", O.with_(O.DELIV, O.REST, O.USERS, O.ORDER_KEYS, O.CALENDAR,
                                                _INC_ORDERS) + """
SELECT d.delivery_id, inc.id AS order_id, d.order_ts, r.rid AS courier_id,
       CAST(d.rate AS DECIMAL(2,1)) AS rate, d.dsum AS sum, d.tip AS tip_sum
FROM deliv d JOIN inc ON inc.order_key = d.order_key JOIN rest r ON r.s_suppkey = d.l_suppkey""")
def q_dds_incremental_deliveries(spark, sf_dir):
    """Deliveries after two runs by (delivery time, id): shipped before the
    cut-off, then the rest; each run has rows."""
    wh = _two_runs(spark, sf_dir, ["dm_couriers", *_ORDER_TABLES, "fct_deliveries"])
    return wh.read("fct_deliveries")


@register("dds_incremental_all", O.with_(O.REST, O.USERS, O.ORDER_KEYS, O.CALENDAR, O.PRODUCTS,
                                         _INC_ORDERS) + """
SELECT 'dm_couriers' AS table_name, count(*) AS n_rows, max(rid) AS top, 0 AS waiting, 0 AS bad FROM rest
UNION ALL SELECT 'dm_users', count(*), max(uid), 0, 0 FROM usr
UNION ALL SELECT 'dm_restaurants', count(*), max(rid), 0, 0 FROM rest
UNION ALL SELECT 'dm_timestamps', count(*), max(tid), 0, 0 FROM cal
UNION ALL SELECT 'dm_products', count(*), max(pid), 0, 0 FROM prod
UNION ALL SELECT 'dm_orders', count(*), max(id), 0, 0 FROM inc
UNION ALL SELECT 'fct_product_sales', count(*), (SELECT max(id) FROM inc), 0, 0 FROM lineitem
UNION ALL SELECT 'fct_deliveries', count(*), (SELECT max(id) FROM inc), 0, 0 FROM lineitem""")
def q_dds_incremental_all(spark, sf_dir):
    """Every dds table after two runs in build order: rows, largest id (or order
    id of a fact), rows still waiting and rows rejected."""
    wh = _two_runs(spark, sf_dir)

    def size(table: Table):
        rows = table.read()
        return F.lit(0) if rows is None else F.lit(rows.count())

    out = None
    for name in wh.target:
        rows = wh.read(name)
        row = rows.agg(F.count(F.lit(1)).alias("n_rows"),
                       F.max("id" if "id" in rows.columns else "order_id").alias("top")).select(
            F.lit(name).alias("table_name"), "n_rows", "top", size(wh.pending[name]).cast("int").alias("waiting"),
            size(wh.rejected[name]).cast("int").alias("bad"))
        out = row if out is None else out.unionByName(row)
    return out


# Late parents: calendar rows and every other user come in the second run, and a
# third of the orders get a newer document there.
CALENDAR_FIRST_END = _dt.date(1996, 1, 1)

_LATE = f"""k AS (
  SELECT k.l_orderkey, k.order_key, k.order_status, r.rid AS restaurant_id, c.tid AS tid, u.uid AS uid,
         CASE WHEN k.l_orderkey % 3 = 0 THEN 'DELIVERING' ELSE k.order_status END AS early,
         k.o_custkey % 2 = 0 AS has_user, k.o_orderdate < DATE '{CALENDAR_FIRST_END}' AS has_day
  FROM okeys k JOIN rest r ON r.s_suppkey = k.l_suppkey
  JOIN usr u ON u.c_custkey = k.o_custkey LEFT JOIN cal c ON c.ts = k.o_orderdate),
f AS (SELECT *, has_user AND (early = 'DELIVERING' OR has_day) AS first_run FROM k),
ids AS (
  SELECT *, CASE WHEN first_run THEN row_number() OVER (PARTITION BY first_run ORDER BY order_key)
            ELSE (SELECT count(*) FROM f WHERE first_run)
                 + row_number() OVER (PARTITION BY first_run ORDER BY order_key) END AS id
  FROM f)"""


@register("dds_incremental_late_parents", O.with_(O.REST, O.USERS, O.ORDER_KEYS, O.CALENDAR, _LATE) + """
SELECT id, order_key, order_status, restaurant_id,
       -- taken while in delivery, before the calendar had its day, and not sent again
       CASE WHEN order_status = 'DELIVERING' AND l_orderkey % 3 <> 0 AND first_run AND NOT has_day
            THEN NULL ELSE tid END AS timestamp_id
FROM ids""")
def q_dds_incremental_late_parents(spark, sf_dir):
    """Orders whose user or calendar row, or newer document, comes in run 2: all
    of them end in the table, in their newest version, with first-run ids kept."""
    configure(spark)
    stg = materialized_stg(spark, sf_dir)
    wh = Warehouse(spark, scratch_path(spark, "dds-late"))
    third = F.pmod(F.split_part("object_id", F.lit("-"), F.lit(1)).cast("long"), F.lit(3)) == 0
    early = stg["orders"].withColumn("object_value", F.when(third, F.regexp_replace(
        "object_value", '"final_status":"[A-Z]+"', '"final_status":"DELIVERING"')).otherwise(F.col("object_value")))
    newer = stg["orders"].filter(third).withColumn("update_ts", F.col("update_ts") + F.expr("INTERVAL 100 YEARS"))
    users = stg["users"].filter(F.pmod(F.col("object_id").cast("long"), F.lit(2)) == 0)
    run_dds(stg.with_(users=users), wh, only=["dm_users", "dm_restaurants"])
    run_dds(stg, wh, until=CALENDAR_FIRST_END, only=["dm_timestamps"])
    run_dds(stg.with_(orders=early), wh, only=["dm_orders"])
    late = stg["users"].filter(F.pmod(F.col("object_id").cast("long"), F.lit(2)) != 0).withColumn(
        "update_ts", F.col("update_ts") + F.expr("INTERVAL 1 DAY"))
    run_dds(stg.with_(users=late), wh, only=["dm_users", "dm_timestamps"])
    run_dds(stg.with_(orders=newer), wh, only=["dm_orders"])
    return wh.read("dm_orders").select("id", "order_key", "order_status", "restaurant_id", "timestamp_id")


@register("dds_incremental_rejects", f"""
WITH keys AS (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem)
SELECT (SELECT max(event_id) + 1 FROM events)
         + l_orderkey * (SELECT max(s_suppkey) + 1 FROM supplier) + l_suppkey AS event_id,
       CASE WHEN l_orderkey % 5 = 0 THEN 'not json' ELSE 'missing order_id' END AS reason
FROM keys WHERE l_orderkey % 5 IN (0, 1)""")
def q_dds_incremental_rejects(spark, sf_dir):
    """Outbox events that arrive cut short or with a renamed field: after two runs
    each stands in the rejected table once, with its reason."""
    configure(spark)
    stg = materialized_stg(spark, sf_dir)
    wh = Warehouse(spark, scratch_path(spark, "dds-rejects"))
    order = F.split_part(F.get_json_object("event_value", "$.order_id"), F.lit("-"), F.lit(1)).cast("long")
    kind = F.when(F.col("event_type") == facts.BONUS_TRANSACTION, F.pmod(order, F.lit(5)))
    body = (F.when(kind == 0, F.expr("substring(event_value, 1, length(event_value) - 1)"))
            .when(kind == 1, F.regexp_replace("event_value", '"order_id"', '"order"'))
            .otherwise(F.col("event_value")))
    events = stg["events"].withColumn("event_value", body)
    feeds = stg.with_(events=events)
    half = events.agg(F.max("id")).collect()[0][0] // 2
    only = [*_ORDER_TABLES, "dm_products"]
    run_dds(feeds, wh, only=only)
    run_dds(feeds.with_(events=events.filter(F.col("id") <= half)), wh, only=["fct_product_sales"])
    run_dds(feeds, wh, only=["fct_product_sales"])
    rows = wh.rejected["fct_product_sales"].read()
    return rows.select(F.get_json_object("body", "$.id").cast("bigint").alias("event_id"), "reason")


# --- loads in order of arrival --------------------------------------------------------------

_SHIPPED = O.DELIV.replace("o.o_orderdate AS order_ts", "o.o_orderdate AS order_ts, l.l_shipdate")


@register("dds_incremental_arrival", O.with_(_SHIPPED, O.REST) + f"""
SELECT d.delivery_id, d.order_key, d.order_ts, r.rid AS courier_id,
       CAST(CASE WHEN d.l_orderkey % 3 = 0 AND d.l_shipdate >= DATE '{FIRST_LOAD_END}'
            THEN 6 - d.rate ELSE d.rate END AS DECIMAL(2,1)) AS rate, d.dsum AS sum
FROM deliv d JOIN rest r ON r.s_suppkey = d.l_suppkey""")
def q_dds_incremental_arrival(spark, sf_dir):
    """Deliveries by order of arrival (S9, S20, B8).  The first load brings those
    shipped from the cut-off on; the second brings the earlier ones, late, half of
    them without a delivery time, and a third of the first once more with a
    corrected rating.  Each run takes what arrived since the last."""
    configure(spark)
    feeds = materialized_stg(spark, sf_dir)
    stg = Staging(spark, scratch_path(spark, "stg-arrival"))
    wh = Warehouse(spark, scratch_path(spark, "dds-arrival"))
    for name in ("couriers", "users", "restaurants", "orders"):
        stg.land(name, feeds[name])
    only = ["dm_couriers", *_ORDER_TABLES, "fct_deliveries"]
    key = F.split_part("order_id", F.lit("-"), F.lit(1)).cast("long")
    first = F.col("delivery_ts") >= D.ts_lit(FIRST_LOAD_END)
    stg.land("deliveries", feeds["deliveries"].filter(first))
    run_dds(stg, wh, only=only)
    corrected = feeds["deliveries"].filter(first & (F.pmod(key, F.lit(3)) == 0)).withColumn(
        "rate", F.lit(6) - F.col("rate"))
    late = feeds["deliveries"].filter(~first).withColumn(
        "delivery_ts", F.when(F.pmod(key, F.lit(2)) == 0, F.col("delivery_ts")))
    stg.land("deliveries", late.unionByName(corrected))
    run_dds(stg, wh, only=only)
    orders = wh.read("dm_orders").select(F.col("id").alias("order_id"), "order_key")
    return wh.read("fct_deliveries").join(orders, "order_id").select(
        "delivery_id", "order_key", "order_ts", "courier_id", "rate", "sum")


@register("dds_incremental_arrival_users", """
SELECT 'loaded' AS place, CAST(c_custkey AS VARCHAR) AS user_id,
       CASE WHEN c_custkey % 10 = 0 THEN c_name || ' (new)' ELSE c_name END AS user_name
FROM customer WHERE c_custkey % 5 <> 1 OR c_custkey % 2 = 0
UNION ALL
SELECT 'null update_ts', CAST(c_custkey AS VARCHAR), CAST(NULL AS VARCHAR)
FROM customer WHERE c_custkey % 5 = 1 AND c_custkey % 2 = 1""")
def q_dds_incremental_arrival_users(spark, sf_dir):
    """Users by order of arrival (B1): even keys first, then the odd ones stamped a
    year before the first, a fifth of those without a time (rejected, NOT NULL), and a
    newer and an older document of every tenth user, of which the newer stays."""
    configure(spark)
    users = materialized_stg(spark, sf_dir)["users"]
    stg = Staging(spark, scratch_path(spark, "stg-arrival-users"))
    wh = Warehouse(spark, scratch_path(spark, "dds-arrival-users"))
    key = F.col("object_id").cast("long")
    stamp = F.col("update_ts")
    even, tenth = F.pmod(key, F.lit(2)) == 0, users.filter(F.pmod(key, F.lit(10)) == 0)

    def named(df, suffix):
        name = F.get_json_object("object_value", "$.name")
        login = F.get_json_object("object_value", "$.login")
        return df.withColumn("object_value", F.to_json(F.struct(
            F.col("object_id").alias("_id"), login.alias("login"), F.concat(name, F.lit(suffix)).alias("name"))))

    late = users.filter(~even).withColumn("update_ts", F.when(
        F.pmod(key, F.lit(5)) != 1, stamp - F.expr("INTERVAL 1 YEAR")))
    loads = [users.filter(even), late.unionByName(named(tenth, " (new)").withColumn(
        "update_ts", stamp + F.expr("INTERVAL 1 DAY"))),
        named(tenth, " (old)").withColumn("update_ts", stamp - F.expr("INTERVAL 1 DAY"))]
    for batch in loads:
        stg.land("users", batch)
        run_dds(stg, wh, only=["dm_users"])
    bad = stg.rejected["users"].read().select(
        F.col("reason").alias("place"), F.get_json_object("body", "$.object_id").alias("user_id"),
        F.lit(None).cast("string").alias("user_name"))
    return wh.read("dm_users").select(F.lit("loaded").alias("place"), "user_id", "user_name").unionByName(bad)


@register("mart_refresh_days", f"""
SELECT r.*, r.settlement_date IN (
         SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % {LATE_SALES} = 0
         ) AS rewritten
FROM ({O.settlement()}) r""")
def q_mart_refresh_days(spark, sf_dir):
    """The daily mart refreshed by what changed (B9, B11, R5): all days after a first
    load, which lacks the sales of every 50th order, and after those arrive the days of
    these orders alone.  Rows as published, and whether the second refresh wrote their day."""
    configure(spark)
    feeds = materialized_stg(spark, sf_dir)
    root = scratch_path(spark, "refresh")
    stg, wh, saved = Staging(spark, f"{root}/stg"), Warehouse(spark, f"{root}/dds"), Table(spark, f"{root}/saved")
    only = [*_ORDER_TABLES, "dm_products", "fct_product_sales"]
    for name in ("users", "restaurants", "orders"):
        stg.land(name, feeds[name])
    key = F.split_part(F.get_json_object("event_value", "$.order_id"), F.lit("-"), F.lit(1)).try_cast("long")
    late = F.coalesce(F.pmod(key, F.lit(LATE_SALES)) == 0, F.lit(False))
    for batch in (feeds["events"].filter(~late), feeds["events"].filter(late)):
        stg.land("events", batch)
        run_dds(stg, wh, only=only)
        done = refresh_marts(wh, f"{root}/settlement", f"{root}/ledger", saved)
    days = spark.createDataFrame([(d,) for d in done.days], "settlement_date date")
    report = spark.read.parquet(f"{root}/settlement")
    return report.join(days.withColumn("again", F.lit(True)), "settlement_date", "left").withColumn(
        "rewritten", F.coalesce("again", F.lit(False))).drop("again")


# --- incremental stg loads ---------------------------------------------------------------

@register("stg_ranks", """
SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name,
       CAST(n_nationkey % 10 AS DECIMAL(19,5)) AS bonus_percent,
       CAST(n_regionkey * 1000 AS DECIMAL(19,5)) AS min_payment_threshold
FROM nation""")
def q_stg_ranks(spark, sf_dir):
    """Bonus ranks loaded by id cursor in two batches (S4), upserted by source id;
    rows that break the source's CHECKs (percent and threshold not negative)
    are rejected by the load."""
    table, bad = _table(spark, "stg-ranks"), _table(spark, "stg-ranks-rejected")
    feed = adapters.bonus_ranks(_t(spark, sf_dir))
    for limit in (10, None):
        run_stg(feed, table, "id", "id", limit, bad, FEEDS["ranks"].not_negative)
    return table.read()


@register("stg_bonus_users_gate", """
SELECT c_custkey AS key, CASE WHEN c_acctbal < 0 THEN 'negative balance' END AS reason FROM customer
UNION ALL SELECT c_custkey, 'null id' FROM customer WHERE c_custkey % 7 = 0""")
def q_stg_bonus_users_gate(spark, sf_dir):
    """Constraints as a gate of the load: customers with their balance, and some sent
    once more without an id, loaded by id cursor in two batches under NOT NULL id
    and CHECK (balance >= 0); the table's rows and the rejected ones with reasons."""
    table, bad = _table(spark, "stg-gate"), _table(spark, "stg-gate-rejected")
    rows = _t(spark, sf_dir).customer.select(F.col("c_custkey").alias("id"), F.col("c_custkey").alias("key"),
                                             F.col("c_acctbal").alias("balance"))
    feed = rows.unionByName(rows.filter(F.pmod("key", F.lit(7)) == 0).withColumn("id", F.lit(None).cast("bigint")))
    for limit in (EVENT_BATCH, None):
        run_stg(feed, table, "id", "id", limit, bad, ("balance",))
    rejected = bad.read().select(F.get_json_object("body", "$.key").cast("bigint").alias("key"), "reason")
    return table.read().select("key", F.lit(None).cast("string").alias("reason")).unionByName(rejected)


@register("stg_bonus_users", """
SELECT c_custkey AS id, CAST(c_custkey AS VARCHAR) AS order_user_id FROM customer""")
def q_stg_bonus_users(spark, sf_dir):
    """Bonus users loaded by id cursor, the source's batch size first."""
    table = _table(spark, "stg-bonus-users")
    feed = adapters.bonus_users(_t(spark, sf_dir))
    run_stg(feed, table, "id", "id", limit=EVENT_BATCH)
    run_stg(feed, table, "id", "id")
    return table.read()


@register("stg_incremental_orders", """
SELECT DISTINCT CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_suppkey AS VARCHAR) AS object_id,
       CAST(o.o_orderdate AS TIMESTAMP) AS update_ts
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey""")
def q_stg_incremental_orders(spark, sf_dir):
    """Order documents loaded by the (time, key) cursor: one batch of the source's
    size, which cuts through equal times, then the rest (S1, S12)."""
    configure(spark)
    table = _table(spark, "stg-orders")
    feed = materialized_stg(spark, sf_dir)["orders"]
    run_stg(feed, table, limit=DOC_BATCH)
    run_stg(feed, table)
    return table.read().select("object_id", "update_ts")
