"""Hot keys: one key holding a third of all rows."""

import datetime as dt
import json
from decimal import Decimal

from pyspark.sql import functions as F

from tabulark.operators.dedupe import latest_per_key
from tabulark.plans import facts, marts
from tabulark.session import scratch_path
from tabulark.sources import adapters
from tabulark.sources.driver import Tables


def _driver_tables(spark, n_lines=600, hot_share=3):
    """Tiny driver-shaped tables where order 0 holds a third of all lines."""
    root = scratch_path(spark, "skew-driver")
    lines = []
    for i in range(n_lines):
        order = 0 if i % hot_share == 0 else 1 + i
        lines.append((order, i % 50, i % 5, i, 1.0 + i % 7, 10.0 + i, 0.05, 0.02, "N", "O",
                      dt.datetime(1996, 1, 2)))
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, "
                          "l_linenumber int, l_quantity double, l_extendedprice double, "
                          "l_discount double, l_tax double, l_returnflag string, "
                          "l_linestatus string, l_shipdate timestamp_ntz") \
        .write.parquet(f"{root}/lineitem.parquet")
    orders = [(o, 1, "F", 1.0, dt.datetime(1996, 1, 1), "1") for o in {r[0] for r in lines}]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, "
                          "o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string") \
        .write.parquet(f"{root}/orders.parquet")
    spark.createDataFrame([(p, f"p{p}", "b", "t", 1, 5.0 + p) for p in range(50)],
                          "p_partkey long, p_name string, p_brand string, p_type string, "
                          "p_size int, p_retailprice double").write.parquet(f"{root}/part.parquet")
    spark.createDataFrame([(s, f"S{s}", 1, 0.0) for s in range(5)],
                          "s_suppkey long, s_name string, s_nationkey int, s_acctbal double") \
        .write.parquet(f"{root}/supplier.parquet")
    spark.createDataFrame([(0, dt.datetime(2024, 1, 1), 1, "click", 1.0, '{"k": 1}')],
                          "event_id long, ts timestamp_ntz, user_id long, event_type string, "
                          "value double, props string").write.parquet(f"{root}/events.parquet")
    return Tables(spark, root), lines


def test_hot_order_events_are_complete_and_stable(spark):
    t, lines = _driver_tables(spark)
    ev = adapters.bonus_transactions(t)
    ids = {json.loads(r.event_value)["order_id"]: r.id for r in ev.collect()}
    assert len(ids) == len({(r[0], r[2]) for r in lines}) == len(set(ids.values()))
    # Another order's line leaves every other event id as it was.
    t.__dict__["lineitem"] = t.lineitem.filter("l_orderkey <> 2")
    again = {json.loads(r.event_value)["order_id"]: r.id for r in adapters.bonus_transactions(t).collect()}
    del t.__dict__["lineitem"]
    assert again and all(ids[k] == v for k, v in again.items())
    exploded, bad = facts.sale_rows(ev)
    assert bad.count() == 0
    assert exploded.count() == len(lines)
    hot = exploded.filter(F.col("order_key").startswith("0-")).agg(F.sum("total_sum")).collect()[0][0]
    want = sum(Decimal(str(r[5])) for r in lines if r[0] == 0)
    assert hot == want


def test_hot_key_latest_per_key(spark):
    rows = [("hot", i, f"v{i}") for i in range(900)] + [(f"k{i}", 0, "x") for i in range(1800)]
    df = spark.createDataFrame(rows, "k string, ts int, v string").repartition(8)
    got = {r.k: r.v for r in latest_per_key(df, ["k"], ["ts"]).collect()}
    assert got["hot"] == "v899" and len(got) == 1801


def test_hot_order_settlement_is_exact(spark):
    n = 900
    sales = spark.createDataFrame(
        [(i, 0, 1, 0 if i % 3 == 0 else i, 1, Decimal("1"), Decimal(f"{i}.10"), Decimal("0.50"),
          Decimal("0.25")) for i in range(n)],
        "event_id long, position int, product_id long, order_id long, count int, "
        "price decimal(19,5), total_sum decimal(19,5), bonus_payment decimal(19,5), "
        "bonus_grant decimal(19,5)").repartition(8)
    order_ids = sorted({0} | {i for i in range(n) if i % 3})
    orders = spark.createDataFrame([(o, f"o{o}", "CLOSED", 1, 1, 1) for o in order_ids],
                                   "id long, order_key string, order_status string, "
                                   "restaurant_id long, timestamp_id long, user_id long")
    rest = spark.createDataFrame([(1, "r1", "Cafe")], "id long, restaurant_id string, restaurant_name string")
    cal = spark.createDataFrame([(1, dt.datetime(2023, 7, 3), "2023-07-03")],
                                "id long, ts timestamp_ntz, ts_date string")
    r = marts.settlement_report(sales, orders, rest, cal).collect()[0]
    total = sum(Decimal(f"{i}.10") for i in range(n))
    assert r.orders_count == n
    assert r.orders_total_sum == total
    assert r.order_processing_fee == (total * Decimal("0.25")).quantize(Decimal("0.00001"))


def test_hot_courier_in_a_month_has_several_writers(spark):
    """One courier with a third of a month's deliveries: the rebalanced write
    splits the month among several files."""
    from tabulark.plans.dds import _written
    keys = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor")
    before = spark.conf.get(keys[0])
    spark.conf.set(keys[0], "64k")
    try:
        rows = spark.range(0, 60_000, numPartitions=8).select(
            F.col("id").alias("delivery_id"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("courier_id"),
            F.lit(dt.datetime(2024, 1, 5)).alias("order_ts"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
        out = _written(spark, rows, "t-hot-month", ("order_month", lambda: F.trunc("order_ts", "month")))
        assert out.count() == 60_000 and len(out.inputFiles()) > 2
    finally:
        spark.conf.set(keys[0], before)
