"""Source feeds derived from the driver's tables.

The warehouse reads three source systems: order-system documents (JSON
text), the bonus-system outbox, and courier-service pages.  These
functions derive each feed from the driver's tables with Spark, so every
pipeline run reads the given data and its work grows with it.

Mapping (one row each):
  user        customer   user_id=c_custkey, name=c_name, login=lower(c_name)
  restaurant  supplier   restaurant_id=s_suppkey, name=s_name, menu from part
  product     part       product_id=p_partkey, restaurant=p_partkey mod #suppliers
  order       lineitem x orders per (l_orderkey, l_suppkey), key "orderkey-suppkey"
  courier     supplier   courier_id=s_suppkey
  delivery    lineitem x orders
  outbox      events (as is) + one bonus_transaction event per order
  rank        nation     id=n_nationkey, name=n_name, percent and threshold from its keys
  bonus user  customer   id=c_custkey
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import DATETIME_FORMAT
from ..functions.money import money
from .driver import Tables

# Order status by the driver's o_orderstatus code.
ORDER_STATUS = {"F": "CLOSED", "O": "CANCELLED", "P": "DELIVERING"}
# Fixed value: update time stamped on user and restaurant documents
# (the driver's customer/supplier rows carry no time of their own).
DIRECTORY_UPDATE_TS = _dt.datetime(2022, 1, 1)


def _scalar(df: DataFrame) -> int:
    return int(df.collect()[0][0] or 0)


def supplier_count(t: Tables) -> int:
    return _scalar(t.supplier.agg(F.count(F.lit(1))))


def supplier_key_bound(t: Tables) -> int:
    return _scalar(t.supplier.agg(F.max("s_suppkey") + 1))


def event_id_base(t: Tables) -> int:
    return _scalar(t.events.agg(F.max("event_id") + 1))


def status_of(code: Column) -> Column:
    out = None
    for k, v in ORDER_STATUS.items():
        out = F.when(code == k, F.lit(v)) if out is None else out.when(code == k, F.lit(v))
    return out


def order_key(orderkey: Column, suppkey: Column) -> Column:
    return F.concat_ws("-", orderkey.cast("string"), suppkey.cast("string"))


def _ts_text(c: Column) -> Column:
    return F.date_format(c, DATETIME_FORMAT)


def rating(l_suppkey: Column, l_orderkey: Column, l_linenumber: Column) -> Column:
    """Delivery rating rule of the fixtures (gives couriers in every tier)."""
    s = F.pmod(l_suppkey, F.lit(4))
    x = l_orderkey + l_linenumber
    return (F.when(s == 0, F.lit(1) + F.pmod(x, F.lit(5)))
            .when(s == 1, F.when(F.pmod(x, F.lit(4)) == 0, F.lit(5)).otherwise(F.lit(4)))
            .when(s == 2, F.when(F.pmod(x, F.lit(4)) == 0, F.lit(4)).otherwise(F.lit(5)))
            .otherwise(F.lit(5))).cast("int")


# --- order-system documents ---------------------------------------------------

def order_documents(t: Tables) -> DataFrame:
    """One document per order key (an order is one supplier's part of a driver order)."""
    # Dealt by order, once for the distinct keys and for the join.
    keys = t.lineitem.select("l_orderkey", "l_suppkey").repartition("l_orderkey").distinct()
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    j = keys.join(o, keys["l_orderkey"] == o["o_orderkey"])
    _id = order_key(F.col("l_orderkey"), F.col("l_suppkey"))
    ts = _ts_text(F.col("o_orderdate"))
    body = F.struct(
        _id.alias("_id"),
        status_of(F.col("o_orderstatus")).alias("final_status"),
        F.struct(F.col("l_suppkey").cast("string").alias("id")).alias("restaurant"),
        ts.alias("ts_date"),
        ts.alias("update_ts"),
        F.struct(F.col("o_custkey").cast("string").alias("id")).alias("user"),
    )
    return j.select(_id.alias("object_id"), F.to_json(body).alias("object_value"),
                    F.col("o_orderdate").cast("timestamp_ntz").alias("update_ts"))


def restaurant_documents(t: Tables) -> DataFrame:
    """One document per supplier with its menu (the parts it sells).

    The menu is the document's own array, as the source system stores it.
    Parts go to restaurants by ``p_partkey mod #suppliers``; with the
    driver's contiguous part keys every menu has at most
    ceil(#parts / #suppliers) items, so the array is bounded by the mapping.
    """
    n = supplier_count(t)
    item = F.struct(F.col("p_partkey").cast("string").alias("_id"),
                    F.col("p_name").alias("name"),
                    money("p_retailprice").alias("price"))
    menus = (t.part.select(F.pmod(F.col("p_partkey"), F.lit(n)).alias("rid"), item.alias("item"))
             .groupBy("rid").agg(F.array_sort(F.collect_list("item")).alias("menu")))
    s = t.supplier.select("s_suppkey", "s_name")
    j = s.join(menus, s["s_suppkey"] == menus["rid"], "left")
    body = F.struct(
        F.col("s_suppkey").cast("string").alias("_id"),
        F.coalesce(F.col("menu"), F.array().cast(menus.schema["menu"].dataType)).alias("menu"),
        F.col("s_name").alias("name"),
        F.lit(DIRECTORY_UPDATE_TS.isoformat(sep=" ")).alias("update_ts"),
    )
    return j.select(F.col("s_suppkey").cast("string").alias("object_id"),
                    F.to_json(body).alias("object_value"),
                    F.lit(DIRECTORY_UPDATE_TS.isoformat(sep=" ")).cast("timestamp_ntz").alias("update_ts"))


def user_documents(t: Tables) -> DataFrame:
    body = F.struct(F.col("c_custkey").cast("string").alias("_id"),
                    F.lower("c_name").alias("login"),
                    F.col("c_name").alias("name"))
    return t.customer.select(F.col("c_custkey").cast("string").alias("object_id"),
                             F.to_json(body).alias("object_value"),
                             F.lit(DIRECTORY_UPDATE_TS.isoformat(sep=" ")).cast("timestamp_ntz")
                             .alias("update_ts"))


# --- bonus system -----------------------------------------------------------

def bonus_users(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("id"),
                             F.col("c_custkey").cast("string").alias("order_user_id"))


def bonus_ranks(t: Tables) -> DataFrame:
    """Bonus ranks: percent and threshold are non-negative by construction, as
    the source system's CHECKs ask."""
    return t.nation.select(
        F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("name"),
        F.pmod(F.col("n_nationkey"), F.lit(10)).cast("decimal(19,5)").alias("bonus_percent"),
        (F.col("n_regionkey") * F.lit(1000)).cast("decimal(19,5)").alias("min_payment_threshold"))


_SALE_FIELDS = ["l_partkey", "p_retailprice", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def sale_lines(t: Tables) -> DataFrame:
    """Lineitem with its product's price, as the driver stores the values."""
    li = t.lineitem
    p = t.part.select("p_partkey", "p_retailprice")
    return li.join(p, li["l_partkey"] == p["p_partkey"]).select("l_orderkey", "l_suppkey", *_SALE_FIELDS)


def payment(line: Column) -> Column:
    """A sale line as product payment (money cast to decimal before arithmetic)."""
    cost = money(line["l_extendedprice"])
    return F.struct(
        line["l_partkey"].cast("string").alias("product_id"),
        money(line["p_retailprice"]).alias("price"),
        line["l_quantity"].cast("int").alias("quantity"),
        cost.alias("product_cost"),
        (cost * money(line["l_discount"])).cast("decimal(19,5)").alias("bonus_payment"),
        (cost * money(line["l_tax"])).cast("decimal(19,5)").alias("bonus_grant"))


def bonus_transactions(t: Tables) -> DataFrame:
    """One ``bonus_transaction`` outbox event per order, with its payments.

    The event is the source system's own document: it holds one order's payment
    lines, so its size is that of an order (one to seven lines in the driver's
    tables).  Its id comes from the order's own keys, above every id of the
    driver's events table: other orders' lines never change it.
    """
    base, suppliers = event_id_base(t), supplier_key_bound(t)
    # Lines are dealt once, by order, for the grouping and for the join, and as the
    # driver stores them: half as wide as the payments made of them.
    lines = sale_lines(t).repartition("l_orderkey")
    events = (lines.groupBy("l_orderkey", "l_suppkey")
              .agg(F.collect_list(F.struct(*_SALE_FIELDS)).alias("lines"))
              .select("l_orderkey", "l_suppkey", F.array_sort(F.transform("lines", payment)).alias("payments")))
    o = t.orders.select("o_orderkey", "o_orderdate")
    j = events.join(o, events["l_orderkey"] == o["o_orderkey"])
    body = F.struct(order_key(F.col("l_orderkey"), F.col("l_suppkey")).alias("order_id"),
                    F.col("payments").alias("product_payments"))
    return j.select(
        (F.lit(base) + F.col("l_orderkey") * F.lit(suppliers) + F.col("l_suppkey")).alias("id"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("event_ts"),
        F.lit("bonus_transaction").alias("event_type"),
        F.to_json(body).alias("event_value"),
    )


def outbox_events(t: Tables) -> DataFrame:
    """The bonus-system outbox: the driver's events plus bonus transactions."""
    ev = t.events.select(F.col("event_id").alias("id"),
                         F.col("ts").cast("timestamp_ntz").alias("event_ts"),
                         "event_type", F.col("props").alias("event_value"))
    return ev.unionByName(bonus_transactions(t))


# --- courier service ----------------------------------------------------------

def courier_pages(t: Tables) -> DataFrame:
    return t.supplier.select(F.col("s_suppkey").cast("string").alias("_id"),
                             F.col("s_name").alias("name"))


def delivery_pages(t: Tables) -> DataFrame:
    li = t.lineitem
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    total = (money("l_extendedprice") * F.lit(_dec("0.01"))).cast("decimal(19,5)")
    return j.select(
        order_key(F.col("l_orderkey"), F.col("l_suppkey")).alias("order_id"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("order_ts"),
        F.concat_ws("-", *[F.col(c).cast("string") for c in
                           ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")],
                    F.col("l_quantity").cast("decimal(19,2)").cast("string"),
                    F.col("l_extendedprice").cast("decimal(19,2)").cast("string"))
        .alias("delivery_id"),
        F.col("l_suppkey").cast("string").alias("courier_id"),
        F.concat(F.lit("customer "), F.col("o_custkey").cast("string")).alias("address"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("delivery_ts"),
        rating(F.col("l_suppkey"), F.col("l_orderkey"), F.col("l_linenumber")).alias("rate"),
        total.alias("sum"),
        (total * money("l_tax")).cast("decimal(19,5)").alias("tip_sum"),
    )


def _dec(text: str):
    from decimal import Decimal
    return Decimal(text)


FEED_BUILDERS = {
    "orders": order_documents,
    "restaurants": restaurant_documents,
    "users": user_documents,
    "events": outbox_events,
    "couriers": courier_pages,
    "deliveries": delivery_pages,
    "ranks": bonus_ranks,
    "bonus_users": bonus_users,
}


def feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All stg feeds of one driver folder."""
    t = Tables(spark, sf_dir)
    return {name: build(t) for name, build in FEED_BUILDERS.items()}
