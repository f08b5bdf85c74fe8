"""Registered dds-layer queries: dimensions and facts."""

from __future__ import annotations

from . import oracle_sql as O
from .catalog import dds, register
from .plans import facts
from .plans.dds import materialized_stg

_CAL = O.with_(O.ORDER_KEYS, O.CALENDAR)
_DMO = O.with_(O.REST, O.USERS, O.ORDER_KEYS, O.CALENDAR, O.DM_ORDERS)


@register("dim_users", O.with_(O.USERS) + """
SELECT uid AS id, ukey AS user_id, c_name AS user_name, login AS user_login FROM usr""")
def q_dim_users(spark, sf_dir):
    return dds(spark, sf_dir)["dm_users"]


@register("dim_restaurants", O.with_(O.REST) + """
SELECT rid AS id, rkey AS restaurant_id, s_name AS restaurant_name,
       TIMESTAMP '2022-01-01 00:00:00' AS active_from,
       TIMESTAMP '2099-12-31 00:00:00' AS active_to
FROM rest""")
def q_dim_restaurants(spark, sf_dir):
    return dds(spark, sf_dir)["dm_restaurants"]


@register("dim_couriers", O.with_(O.REST) + """
SELECT rid AS id, rkey AS courier_id, s_name AS courier_name FROM rest""")
def q_dim_couriers(spark, sf_dir):
    return dds(spark, sf_dir)["dm_couriers"]


@register("dim_products", O.with_(O.REST, O.PRODUCTS) + """
SELECT p.pid AS id, p.pkey AS product_id, p.p_name AS product_name, p.product_price,
       TIMESTAMP '2022-01-01 00:00:00' AS active_from,
       TIMESTAMP '2099-12-31 00:00:00' AS active_to, r.rid AS restaurant_id
FROM prod p JOIN rest r ON r.s_suppkey = p.rsupp""")
def q_dim_products(spark, sf_dir):
    return dds(spark, sf_dir)["dm_products"]


@register("dim_timestamps", _CAL + """
SELECT tid AS id, ts, CAST(year(ts) AS INTEGER) AS ts_year, CAST(month(ts) AS INTEGER) AS ts_month,
       CAST(day(ts) AS INTEGER) AS ts_day, strftime(ts, '%Y-%m-%d') AS ts_date,
       strftime(ts, '%H:%M:%S') AS ts_time
FROM cal""")
def q_dim_timestamps(spark, sf_dir):
    return dds(spark, sf_dir)["dm_timestamps"]


@register("dim_orders", _DMO + """
SELECT oid AS id, order_key, order_status, rid AS restaurant_id, tid AS timestamp_id,
       uid AS user_id
FROM dmo""")
def q_dim_orders(spark, sf_dir):
    return dds(spark, sf_dir)["dm_orders"].drop("order_month")


# Payment lines of an order in payment order; one event per order.
_SALES_POS = O.SALES_POS
_EVENT_ID = O.EVENT_ID


@register("fct_product_sales", O.with_(O.SALES, O.REST, O.USERS, O.ORDER_KEYS, O.CALENDAR,
                                       O.DM_ORDERS, O.PRODUCTS, _SALES_POS) + f"""
SELECT {_EVENT_ID} AS event_id, CAST(s2.position AS INTEGER) AS position,
       p.pid AS product_id, d.oid AS order_id, s2.cnt AS count, s2.price, s2.total_sum,
       s2.bonus_payment, s2.bonus_grant
FROM s2
JOIN prod p ON p.p_partkey = s2.l_partkey
JOIN dmo d ON d.l_orderkey = s2.l_orderkey AND d.l_suppkey = s2.l_suppkey""")
def q_fct_product_sales(spark, sf_dir):
    return dds(spark, sf_dir)["fct_product_sales"].drop("order_month")


@register("fct_deliveries", O.with_(O.DELIV, O.REST, O.USERS, O.ORDER_KEYS, O.CALENDAR,
                                    O.DM_ORDERS) + """
SELECT d.delivery_id, o.oid AS order_id, d.order_ts, r.rid AS courier_id,
       CAST(d.rate AS DECIMAL(2,1)) AS rate, d.dsum AS sum, d.tip AS tip_sum
FROM deliv d
JOIN dmo o ON o.order_key = d.order_key
JOIN rest r ON r.s_suppkey = d.l_suppkey""")
def q_fct_deliveries(spark, sf_dir):
    return dds(spark, sf_dir)["fct_deliveries"].drop("order_month")


@register("json_explode", O.with_(O.SALES, _SALES_POS) + f"""
SELECT {_EVENT_ID} AS event_id, CAST(s2.position AS INTEGER) AS position,
       CAST(s2.l_orderkey AS VARCHAR) || '-' || CAST(s2.l_suppkey AS VARCHAR) AS order_key,
       CAST(s2.l_partkey AS VARCHAR) AS product_key, s2.cnt AS count, s2.price, s2.total_sum,
       s2.bonus_payment, s2.bonus_grant
FROM s2""")
def q_json_explode(spark, sf_dir):
    """Bonus-transaction JSON text -> one row per payment (array explode)."""
    lines, _bad = facts.sale_rows(materialized_stg(spark, sf_dir)["events"])
    return lines
