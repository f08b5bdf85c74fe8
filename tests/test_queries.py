"""End to end on sf0.001: entry, registry, oracle parity, plan properties."""

import datetime as dt
import decimal
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402
from tabulark import catalog  # noqa: E402
from tabulark.plans import marts  # noqa: E402
from tabulark.sources.driver import TABLES  # noqa: E402

from conftest import SF0001  # noqa: E402

ORACLE_KEYS = sorted(catalog.queries())


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f")
    if isinstance(v, float):
        return repr(round(v, 6))
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    return "NULL" if v is None else str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["restaurant_id", "restaurant_name", "settlement_date", "orders_count",
                          "orders_total_sum", "orders_bonus_payment_sum",
                          "orders_bonus_granted_sum", "order_processing_fee",
                          "restaurant_reward_sum"]
    assert df.count() > 0


def test_registry_has_oracle_for_every_query():
    assert set(catalog.oracle()) == set(catalog.queries())
    assert len(catalog.queries()) >= 56
    assert set(catalog.queries()) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", ORACLE_KEYS)
def test_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF0001)
    res = duck.sql(E.oracle_sql()[key])
    assert sorted(df.columns) == sorted(res.columns)
    assert _rows(df.columns, df.collect()) == _rows(res.columns, res.fetchall())


def test_range_backfill_equals_union_of_periods(spark):
    t = catalog.dds(spark, SF0001)
    args = (t["fct_product_sales"], t["dm_orders"], t["dm_restaurants"], t["dm_timestamps"])
    days = [dt.date(2000, 1, 1) + dt.timedelta(days=i) for i in range(5)]
    whole = marts.settlement_report(*args, first_day=days[0], last_day=days[-1], ordered=False)
    parts = None
    for d in days:
        one = marts.settlement_report(*args, first_day=d, ordered=False)
        parts = one if parts is None else parts.unionByName(one)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, parts.collect()))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_stay_in_the_jvm_and_push_filters(spark):
    for key in ["settlement_day", "courier_month", "courier_ledger_minute_join", "dedupe_latest"]:
        df = E.queries()[key](spark, SF0001)
        text = df._jdf.queryExecution().toString()
        assert "PythonUDF" not in text and "ArrowEvalPython" not in text and "BatchEvalPython" not in text
        assert "Window" not in text  # no window at all, so no unpartitioned one
    day = E.queries()["settlement_day"](spark, SF0001)
    text = day._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(ts" in text
    assert text.count("PartitionFilters: [isnotnull(order_month") >= 2  # orders and sales
    month = E.queries()["courier_month"](spark, SF0001)
    plan = month._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(order_ts" in plan
    assert "PartitionFilters: [isnotnull(order_month" in plan  # month folders pruned
