"""Detail-layer dimensions (B1-B6) built from stg documents.

Each build is: permissive parse (bad rows to quarantine), latest version
per natural key, lookups to parent dimensions by natural key, dense
surrogate ids in natural-key order.  Lookups of keys that are not loaded
yet leave the row pending instead of failing the batch.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import OPEN_END, calendar_parts, parse_ts, ts_lit
from ..operators.dedupe import latest_per_key, newest_rows
from ..operators.ids import assign_dense_ids
from ..operators.pending import resolve
from ..operators.quarantine import split_parsed, tag_parsed
from ..operators.versions import close_versions
from ..session import stored
from ..sources.sinks import ARRIVED
from .. import schemas as S

# Order statuses that get a calendar entry.
CALENDAR_STATUSES = ["CLOSED", "CANCELLED"]


@dataclass
class Built:
    """A built table plus the rows it could not take yet."""
    table: DataFrame
    rejected: DataFrame | None = None   # malformed source rows
    pending: DataFrame | None = None    # rows waiting for a parent


# Stores rows that a table and its pending rows are both taken from.
Kept = Callable[[DataFrame, str], DataFrame]


def _open_end():
    return ts_lit(OPEN_END)


def _numbered(rows: DataFrame, keys: list[str], start: int, with_ids: bool) -> DataFrame:
    """Rows with dense ids in key order; without, ids are left to the sink."""
    return assign_dense_ids(rows, keys, start=start) if with_ids else rows


def dim_users(stg_users: DataFrame, start: int = 0, with_ids: bool = True) -> Built:
    good, bad = split_parsed(stg_users, "object_value", S.USER_BODY, ["_id"])
    rows = good.select(F.col("body._id").alias("user_id"), F.col("body.name").alias("user_name"),
                       F.col("body.login").alias("user_login"), "update_ts")
    latest = latest_per_key(rows, ["user_id"], ["update_ts"])
    if not with_ids:
        return Built(latest, rejected=bad)  # update_ts stays, for the merge
    return Built(assign_dense_ids(latest.drop("update_ts"), ["user_id"], start=start), rejected=bad)


def dim_restaurants(stg_restaurants: DataFrame, start: int = 0, versions: bool = False,
                    with_ids: bool = True) -> Built:
    """One open version per restaurant (default, as the source system keeps
    it), or with ``versions`` every document version, each closed where the
    next one begins (Q15)."""
    good, bad = split_parsed(stg_restaurants, "object_value", S.RESTAURANT_BODY, ["_id"])
    rows = good.select(F.col("body._id").alias("restaurant_id"),
                       F.col("body.name").alias("restaurant_name"),
                       parse_ts("body.update_ts").alias("active_from"), "update_ts")
    if versions:
        per_version = latest_per_key(rows.filter(F.col("active_from").isNotNull()),
                                     ["restaurant_id", "active_from"], ["update_ts"]).drop("update_ts")
        table = close_versions(per_version, "restaurant_id", "active_from", same=["restaurant_name"])
        return Built(assign_dense_ids(table, ["restaurant_id", "active_from"], start=start),
                     rejected=bad)
    latest = latest_per_key(rows, ["restaurant_id"], ["update_ts"])
    table = latest.withColumn("active_to", _open_end())
    if not with_ids:
        return Built(table, rejected=bad)
    table = table.drop("update_ts")
    return Built(assign_dense_ids(table, ["restaurant_id"], start=start), rejected=bad)


def dim_products(stg_restaurants: DataFrame, restaurants: DataFrame, start: int = 0,
                 versions: bool = False, pending: DataFrame | None = None,
                 with_ids: bool = True, kept: Kept | None = None) -> Built:
    """Products from the menu arrays of the latest restaurant documents, or
    with ``versions`` one version per product and menu change, each closed
    where the next begins (Q15); lookups use the open version (P6)."""
    good, bad = split_parsed(stg_restaurants, "object_value", S.RESTAURANT_BODY, ["_id"])
    docs = good.select("object_id", "update_ts", F.col("body.menu").alias("menu"))
    if not versions:
        docs = latest_per_key(docs, ["object_id"], ["update_ts"])
    items = docs.select("object_id", F.date_trunc("second", "update_ts").cast("timestamp_ntz")
                        .alias("active_from"), F.explode("menu").alias("m"))
    rows = items.select(F.col("m._id").alias("product_id"), F.col("m.name").alias("product_name"),
                        F.col("m.price").alias("product_price"), "active_from",
                        F.col("object_id").alias("restaurant_key"))
    rows = rows.filter(F.col("product_id").isNotNull())
    rows = rows if pending is None else rows.unionByName(pending)
    version_key = ["product_id", "active_from"] if versions else ["product_id"]
    latest = latest_per_key(rows, version_key, ["active_from"] if not versions else
                            ["product_name"])
    r = (restaurants.filter(F.col("active_to") == _open_end())
         .select("restaurant_id", F.col("id").alias("r_id")))
    resolved, waiting = resolve(latest, r, "restaurant_key", "restaurant_id", "r_id", "restaurant_id", kept=kept)
    resolved = resolved.drop("restaurant_key")
    table = (close_versions(resolved, "product_id", "active_from",
                            same=["product_name", "product_price", "restaurant_id"]) if versions
             else resolved.withColumn("active_to", _open_end()))
    table = table.select("product_id", "product_name", "product_price", "active_from", "active_to",
                         "restaurant_id")
    return Built(_numbered(table, version_key, start, with_ids), rejected=bad, pending=waiting)


def parsed_orders(stg_orders: DataFrame) -> DataFrame:
    """Order documents with their fields read, for the calendar and the orders: one row
    per document, with ``reason`` and the source ``row`` where it is rejected."""
    tagged = tag_parsed(stg_orders, "object_value", S.ORDER_BODY, ["_id", "final_status"])
    bad = F.col("_reason").isNotNull()
    return tagged.select(
        F.col("body._id").alias("order_key"), F.col("body.final_status").alias("order_status"),
        F.col("body.restaurant.id").alias("restaurant_key"), F.col("body.user.id").alias("user_key"),
        F.struct(*[parse_ts(f"body.{c}").alias(c) for c in ("ts_date", "update_ts")]).alias("doc_ts"),
        *_arrival(stg_orders), F.col("_reason").alias("reason"),
        F.when(bad, F.struct(*stg_orders.columns)).alias("row"))


def _arrival(stg_orders: DataFrame) -> list[str]:
    return ["update_ts", *([ARRIVED] if ARRIVED in stg_orders.columns else [])]


def _rejected_docs(docs: DataFrame) -> DataFrame:
    return docs.filter(F.col("reason").isNotNull()).select("row.*", "reason")


def dim_timestamps(stg_orders: DataFrame, start: int = 0, ts_field: str = "ts_date",
                   with_ids: bool = True, parsed: DataFrame | None = None, kept: Kept | None = None) -> Built:
    """Calendar of closed and cancelled orders, one row per distinct time.  ``parsed`` are
    the stored ``parsed_orders`` of the feed; ``kept`` stores the distinct times and the
    rejected rows (each once) of one parse."""
    docs = parsed_orders(stg_orders) if parsed is None else parsed
    # A document without a status has no calendar row, and is not rejected here.
    docs = docs.filter(F.col("reason").isNull() | (F.col("reason") != F.lit("missing final_status")))
    counts = F.col("reason").isNull() & F.col("order_status").isin(CALENDAR_STATUSES)
    if kept is not None:
        docs = kept(docs.select(F.when(counts, F.col(f"doc_ts.{ts_field}")).alias("ts"), "reason", "row")
                    .filter(F.col("ts").isNotNull() | F.col("reason").isNotNull()).distinct(), "seen-times")
        ts = docs.select("ts")
    else:
        ts = docs.filter(counts).select(F.col(f"doc_ts.{ts_field}").alias("ts"))
    ts, bad = ts.filter(F.col("ts").isNotNull()).distinct(), _rejected_docs(docs)
    parts = calendar_parts("ts")
    table = ts.select("ts", *[v.alias(k) for k, v in parts.items()])
    return Built(_numbered(table, ["ts"], start, with_ids), rejected=bad)


def dim_orders(stg_orders: DataFrame, restaurants: DataFrame, timestamps: DataFrame,
               users: DataFrame, start: int = 0, ts_field: str = "update_ts",
               pending: DataFrame | None = None, with_ids: bool = True, kept: Kept | None = None,
               parsed: DataFrame | None = None) -> Built:
    """Orders with surrogate parents, the newest document per order.

    A missing restaurant or user makes the order pending, and so does a
    missing calendar row of a closed or cancelled order (Q8); an order still in
    delivery has none, and its ``timestamp_id`` is null.  Waiting rows keep
    ``update_ts`` and compete with newer documents of their order; of two with one
    ``update_ts`` the later to arrive wins, where the feed tells.  Without ids the
    table keeps ``update_ts`` too, for the merge; ``order_month`` is the month of
    the order's time.  ``parsed`` are the stored ``parsed_orders`` of the feed.
    """
    order = _arrival(stg_orders)
    # Read for their keys, whole, and for the rejected ones: parsed once.
    docs = stored(parsed_orders(stg_orders), "parsed-orders") if parsed is None else parsed
    bad = _rejected_docs(docs)
    rows = docs.filter(F.col("reason").isNull()).select(
        "order_key", "order_status", "restaurant_key", "user_key",
        F.col(f"doc_ts.{ts_field}").alias("order_ts"), *order)
    rows = rows if pending is None else rows.unionByName(pending)
    latest = newest_rows(rows, ["order_key"], order)
    if "active_to" in restaurants.columns:  # versioned: look up the open version (P6)
        restaurants = restaurants.filter(F.col("active_to") == _open_end())
    r = restaurants.select(F.col("restaurant_id").alias("r_key"), F.col("id").alias("restaurant_id"))
    u = users.select(F.col("user_id").alias("u_key"), F.col("id").alias("user_id"))
    t = timestamps.select(F.col("ts").alias("t_ts"), F.col("id").alias("timestamp_id"))
    met = (latest.join(r, latest["restaurant_key"] == r["r_key"], "left")
           .join(u, F.col("user_key") == F.col("u_key"), "left")
           .join(t, F.col("order_ts") == F.col("t_ts"), "left")).drop("r_key", "u_key", "t_ts")
    met = met if kept is None else kept(met, "met-orders")
    dated = F.col("order_status").isin(CALENDAR_STATUSES)
    waits = (F.col("restaurant_id").isNull() | F.col("user_id").isNull()
             | (dated & F.col("timestamp_id").isNull()))
    waiting = met.filter(waits).select(*rows.columns)
    table = met.filter(~waits).select(
        "order_key", "order_status", "restaurant_id", "timestamp_id", "user_id",
        F.trunc("order_ts", "month").alias("order_month"), *([] if with_ids else order))
    return Built(_numbered(table, ["order_key"], start, with_ids), rejected=bad, pending=waiting)


def dim_couriers(stg_couriers: DataFrame, start: int = 0, with_ids: bool = True) -> Built:
    rows = stg_couriers.select(F.col("_id").alias("courier_id"), F.col("name").alias("courier_name"))
    bad = rows.filter(F.col("courier_id").isNull() | F.col("courier_name").isNull()).withColumn(
        "reason", F.lit("missing id or name"))
    rows = rows.filter(F.col("courier_id").isNotNull() & F.col("courier_name").isNotNull())
    latest = latest_per_key(rows, ["courier_id"], ["courier_name"])
    return Built(_numbered(latest, ["courier_id"], start, with_ids), rejected=bad)
