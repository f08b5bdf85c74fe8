"""Registered queries: key -> (spark, sf_dir) -> DataFrame, plus oracle SQL.

Every query reads the driver's tables, or tables Spark derives from them
(the dds layer is built from the derived source feeds and written once per
session), so its work grows with the data.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import oracle_sql as O
from .plans import marts
from .plans.dds import materialized_dds
from .session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


def dds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    configure(spark)
    return materialized_dds(spark, sf_dir)


# Fixed periods used by the single-period and range queries (busiest day and
# month of the sf0.01 tables; any period works).
DAY = _dt.date(1995, 10, 14)
MONTH = _dt.date(1995, 7, 1)
RANGE_FIRST_DAY, RANGE_LAST_DAY = _dt.date(1996, 1, 1), _dt.date(1997, 12, 31)
RANGE_FIRST_MONTH, RANGE_LAST_MONTH = _dt.date(1996, 1, 1), _dt.date(1997, 12, 1)


# --- marts -----------------------------------------------------------------------

@register("settlement_report", O.settlement())
def q_settlement_report(spark, sf_dir):
    t = dds(spark, sf_dir)
    return marts.settlement_report(t["fct_product_sales"], t["dm_orders"], t["dm_restaurants"],
                                   t["dm_timestamps"])


@register("settlement_day", O.settlement(f"AND CAST(o.o_orderdate AS DATE) = DATE '{DAY}'"))
def q_settlement_day(spark, sf_dir):
    t = dds(spark, sf_dir)
    return marts.settlement_report(t["fct_product_sales"], t["dm_orders"], t["dm_restaurants"],
                                   t["dm_timestamps"], first_day=DAY)


@register("settlement_report_range", O.settlement(
    f"AND o.o_orderdate >= DATE '{RANGE_FIRST_DAY}' AND o.o_orderdate < DATE '{RANGE_LAST_DAY}' + INTERVAL 1 DAY"))
def q_settlement_report_range(spark, sf_dir):
    t = dds(spark, sf_dir)
    return marts.settlement_report(t["fct_product_sales"], t["dm_orders"], t["dm_restaurants"],
                                   t["dm_timestamps"], first_day=RANGE_FIRST_DAY,
                                   last_day=RANGE_LAST_DAY)


@register("settlement_report_spec", O.settlement(natural_id=True, count_orders=True))
def q_settlement_report_spec(spark, sf_dir):
    t = dds(spark, sf_dir)
    return marts.settlement_report(t["fct_product_sales"], t["dm_orders"], t["dm_restaurants"],
                                   t["dm_timestamps"], natural_restaurant_id=True,
                                   count_orders=True)


@register("courier_ledger", O.ledger())
def q_courier_ledger(spark, sf_dir):
    t = dds(spark, sf_dir)
    return marts.courier_ledger(t["fct_deliveries"], t["dm_couriers"])


@register("courier_month", O.ledger(
    f"AND d.order_ts >= DATE '{MONTH}' AND d.order_ts < DATE '{MONTH}' + INTERVAL 1 MONTH"))
def q_courier_month(spark, sf_dir):
    t = dds(spark, sf_dir)
    return marts.courier_ledger(t["fct_deliveries"], t["dm_couriers"], first_month=MONTH)


@register("courier_ledger_range", O.ledger(
    f"AND d.order_ts >= DATE '{RANGE_FIRST_MONTH}' "
    f"AND d.order_ts < DATE '{RANGE_LAST_MONTH}' + INTERVAL 1 MONTH"))
def q_courier_ledger_range(spark, sf_dir):
    t = dds(spark, sf_dir)
    return marts.courier_ledger(t["fct_deliveries"], t["dm_couriers"],
                                first_month=RANGE_FIRST_MONTH, last_month=RANGE_LAST_MONTH)


@register("courier_tiers", O.tiers())
def q_courier_tiers(spark, sf_dir):
    t = dds(spark, sf_dir)
    return marts.courier_tiers(t["fct_deliveries"])


@register("courier_ledger_per_order", O.ledger(per_order=True))
def q_courier_ledger_per_order(spark, sf_dir):
    t = dds(spark, sf_dir)
    return marts.courier_ledger_per_order(t["fct_deliveries"], t["dm_couriers"])


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle() -> dict[str, str]:
    return dict(ORACLE)


# Register the dds-layer and operator queries (they import this module).
from . import catalog_dds, catalog_ops  # noqa: E402,F401
