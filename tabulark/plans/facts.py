"""Detail-layer facts.

Product sales come from ``bonus_transaction`` outbox events: the payment
array is exploded (position kept, so the fact key is (event id,
position)), the order is looked up by natural key, the product by its
current version.  Unknown parents leave the line pending (D9) instead of
skipping it (Q10) or giving it a zero id (Q11).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import OPEN_END, ts_lit
from ..operators.dedupe import newest_rows
from ..operators.quarantine import split_parsed
from ..sources.scans import scan_cursor_typed
from ..sources.sinks import ARRIVED
from .. import schemas as S
from .dims import Built, Kept

# Fixed value: outbox event type carrying product payments.
BONUS_TRANSACTION = "bonus_transaction"


def sale_rows(events: DataFrame, after_id: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Exploded payment lines of bonus transactions past the id cursor."""
    batch = scan_cursor_typed(events, "id", "event_type", BONUS_TRANSACTION, after=after_id)
    good, bad = split_parsed(batch, "event_value", S.BONUS_TRANSACTION_BODY, ["order_id"])
    lines = good.select(F.col("id").alias("event_id"), F.col("body.order_id").alias("order_key"),
                        F.posexplode("body.product_payments").alias("position", "p"))
    return lines.select("event_id", "position", "order_key",
                        F.col("p.product_id").alias("product_key"),
                        F.col("p.quantity").alias("count"), F.col("p.price").alias("price"),
                        F.col("p.product_cost").alias("total_sum"),
                        F.col("p.bonus_payment").alias("bonus_payment"),
                        F.col("p.bonus_grant").alias("bonus_grant")), bad


def fct_product_sales(events: DataFrame, orders: DataFrame, products: DataFrame,
                      after_id: int | None = None, pending: DataFrame | None = None,
                      kept: Kept | None = None) -> Built:
    lines, bad = sale_rows(events, after_id)
    lines = lines if pending is None else lines.unionByName(pending)
    # The order's month comes along, so that a day's report reads a month's sales.
    dated = "order_month" in orders.columns
    ref = F.struct(F.col("id"), *([F.col("order_month")] if dated else []))
    o = orders.select(F.col("order_key").alias("o_key"), ref.alias("order"))
    current = products.filter(F.col("active_to") == ts_lit(OPEN_END))
    p = current.select(F.col("product_id").alias("p_key"), F.col("id").alias("product_id"))
    # Both lookups before the split, so that lines that wait come from the same joins;
    # a line without its order asks for no product.
    met = (lines.join(o, F.col("order_key") == F.col("o_key"), "left")
           .join(p, (F.col("product_key") == F.col("p_key")) & F.col("order").isNotNull(), "left")
           .drop("o_key", "p_key"))
    met = met if kept is None else kept(met, "met-sales")
    found = F.col("order").isNotNull() & F.col("product_id").isNotNull()
    table = met.filter(found).select("event_id", "position", "product_id", F.col("order.id").alias("order_id"), "count",
                        "price", "total_sum", "bonus_payment", "bonus_grant",
                        *([F.col("order.order_month").alias("order_month")] if dated else []))
    waiting = met.filter(~found).select(*lines.columns)
    return Built(table, rejected=bad, pending=waiting)


def fct_deliveries(stg_deliveries: DataFrame, orders: DataFrame, couriers: DataFrame,
                   pending: DataFrame | None = None, kept: Kept | None = None) -> Built:
    """Deliveries with surrogate order and courier; replays collapse on delivery_id:
    the last to arrive wins where the feed tells its loads, else the newest order time."""
    told = [ARRIVED] if ARRIVED in stg_deliveries.columns else []
    rows = stg_deliveries.select("delivery_id", F.col("order_id").alias("order_key"), "order_ts",
                                 F.col("courier_id").alias("courier_key"), F.col("rate").alias("given"),
                                 F.col("rate").try_cast("decimal(2,1)").alias("rate"), "sum", "tip_sum", *told)
    reason = (F.when(F.col("delivery_id").isNull(), F.lit("missing delivery_id"))
              .when(F.col("order_ts").isNull(), F.lit("missing order_ts"))
              .when(F.col("given").isNotNull() & F.col("rate").isNull(), F.lit("rating out of range")))
    tagged = rows.withColumn("reason", reason)
    bad = tagged.filter(F.col("reason").isNotNull()).drop("rate").withColumnRenamed("given", "rate")
    rows = tagged.filter(F.col("reason").isNull()).drop("reason", "given")
    rows = rows if pending is None else rows.unionByName(pending)
    latest = newest_rows(rows, ["delivery_id"], told or ["order_ts"])
    o = orders.select(F.col("order_key").alias("o_key"), F.col("id").alias("order_id"))
    c = couriers.select(F.col("courier_id").alias("c_key"), F.col("id").alias("courier_id"))
    met = (latest.join(o, F.col("order_key") == F.col("o_key"), "left")
           .join(c, (F.col("courier_key") == F.col("c_key")) & F.col("order_id").isNotNull(), "left")
           .drop("o_key", "c_key"))
    met = met if kept is None else kept(met, "met-deliveries")
    found = F.col("order_id").isNotNull() & F.col("courier_id").isNotNull()
    table = met.filter(found).select("delivery_id", "order_id", "order_ts", "courier_id", "rate", "sum", "tip_sum", *told)
    waiting = met.filter(~found).select(*rows.columns)
    return Built(table, rejected=bad, pending=waiting)
