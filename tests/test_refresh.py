"""Marts refreshed by what the loads changed."""

import datetime as dt

import pytest

from tabulark.plans import refresh
from tabulark.plans.incremental import Warehouse
from tabulark.plans.marts import courier_ledger, settlement_report
from tabulark.session import scratch_path
from tabulark.sources.sinks import Table

DAYS = [dt.datetime(2023, 1, 5, 9), dt.datetime(2023, 1, 6, 9), dt.datetime(2023, 2, 7, 9)]


class Shop:
    """A small detail layer, written straight into a warehouse's tables."""

    def __init__(self, spark):
        self.spark, root = spark, scratch_path(spark, "t-refresh")
        self.wh, self.saved = Warehouse(spark, f"{root}/dds"), Table(spark, f"{root}/saved")
        self.settlement, self.ledger = f"{root}/settlement", f"{root}/ledger"
        self.put("dm_restaurants", [(1, "r1", "R")], "id long, restaurant_id string, restaurant_name string")
        self.put("dm_couriers", [(1, "c1", "C")], "id long, courier_id string, courier_name string")
        self.put("dm_timestamps", [(i + 1, d, d) for i, d in enumerate(DAYS)],
                 "id long, ts timestamp_ntz, ts_date timestamp_ntz")

    def put(self, name, rows, schema):
        self.wh.target[name].upsert(self.spark.createDataFrame(rows, schema), [schema.split()[0]])

    def orders(self, *rows):
        self.put("dm_orders", [(i, i, s, 1, t, DAYS[t - 1].date().replace(day=1)) for i, s, t in rows],
                 "order_key long, id long, order_status string, restaurant_id long, timestamp_id long, order_month date")

    def sales(self, *rows):
        self.wh.target["fct_product_sales"].insert_ignore(self.spark.createDataFrame(
            [(e, 0, o, 1, total, DAYS[t - 1].date().replace(day=1)) for e, o, total, t in rows],
            "event_id long, position int, order_id long, count int, total long, order_month date").selectExpr(
            "event_id", "position", "order_id", "count", "cast(total as decimal(19,5)) as total_sum",
            "cast(0 as decimal(19,5)) as bonus_payment", "cast(0 as decimal(19,5)) as bonus_grant", "order_month"),
            ["event_id", "position"])

    def deliveries(self, *rows):
        self.wh.target["fct_deliveries"].upsert(self.spark.createDataFrame(
            [(d, 1, 1, DAYS[t - 1], rate) for d, t, rate in rows],
            "delivery_id string, order_id long, courier_id long, order_ts timestamp_ntz, rate int").selectExpr(
            "delivery_id", "order_id", "courier_id", "order_ts", "cast(rate as decimal(2,1)) as rate",
            "cast(100 as decimal(19,5)) as sum", "cast(1 as decimal(19,5)) as tip_sum"), ["delivery_id"])

    def refresh(self):
        done = refresh.refresh_marts(self.wh, self.settlement, self.ledger, self.saved)
        return [str(d) for d in done.days], [str(m) for m in done.months]

    def check(self):
        """Both marts as published equal a full build of the tables."""
        r = self.wh.read
        for path, full in ((self.settlement, settlement_report(
                r("fct_product_sales"), r("dm_orders"), r("dm_restaurants"), r("dm_timestamps"))),
                (self.ledger, courier_ledger(r("fct_deliveries"), r("dm_couriers")))):
            got = self.spark.read.schema(full.schema).parquet(path)
            assert sorted(map(str, got.select(*full.columns).collect())) == sorted(map(str, full.collect()))


@pytest.fixture
def shop(spark):
    s = Shop(spark)
    s.orders((1, "CLOSED", 1), (2, "CLOSED", 2), (3, "CLOSED", 3), (4, "DELIVERING", 1))
    s.sales((10, 1, 100, 1), (11, 2, 200, 2), (12, 3, 300, 3), (13, 4, 400, 1))
    s.deliveries(("d1", 1, 3), ("d2", 2, 4), ("d3", 3, 5))
    return s


def test_only_touched_periods_are_published(shop):
    assert shop.refresh() == (["2023-01-05", "2023-01-06", "2023-02-07"], ["2023-01-01", "2023-02-01"])
    shop.check()
    assert shop.refresh() == ([], [])
    shop.sales((14, 2, 50, 2))  # a late sale
    assert shop.refresh() == (["2023-01-06"], [])
    shop.check()
    shop.deliveries(("d3", 3, 1))  # a corrected rating
    assert shop.refresh() == ([], ["2023-02-01"])
    shop.check()
    shop.orders((4, "CLOSED", 1))  # its sale came before
    assert shop.refresh() == (["2023-01-05"], [])
    shop.check()


def test_periods_that_lose_their_last_row_are_emptied(shop):
    shop.refresh()
    shop.orders((3, "CANCELLED", 3))
    shop.deliveries(("d3", 1, 5))  # its order is of January after all
    assert shop.refresh() == (["2023-02-07"], ["2023-01-01", "2023-02-01"])
    shop.check()


def test_an_interrupted_refresh_is_done_again_and_folding_loses_nothing(shop, monkeypatch):
    shop.refresh()
    shop.sales((15, 1, 7, 1))
    with monkeypatch.context() as m:
        m.setattr(refresh.Table, "upsert", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            shop.refresh()
    assert shop.refresh() == (["2023-01-05"], [])
    shop.deliveries(("d1", 2, 1))
    shop.wh.target["fct_deliveries"].compact()
    shop.wh.target["dm_orders"].compact()
    assert shop.refresh() == ([], ["2023-01-01"])
    shop.check()


def test_nothing_is_published_before_the_first_load(spark):
    root = scratch_path(spark, "t-refresh-empty")
    done = refresh.refresh_marts(Warehouse(spark, root), f"{root}-s", f"{root}-l", Table(spark, f"{root}-saved"))
    assert (done.days, done.months) == ([], [])
