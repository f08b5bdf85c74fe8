"""Dedupe, dense ids, cursor scans, quarantine, pending rows, checks, JSON."""

import datetime as dt
import json
from decimal import Decimal

from pyspark.sql import functions as F

from tabulark import schemas as S
from tabulark.functions.json_ops import canonical_json, explode_array, parse
from tabulark.operators import checks
from tabulark.operators.dedupe import latest_per_key
from tabulark.operators.ids import assign_dense_ids
from tabulark.operators.pending import resolve
from tabulark.operators.quarantine import split_parsed
from tabulark.plans import dims, facts
from tabulark.sources.scans import batch_bookmark, scan_cursor_ts, scan_offset_page


def test_latest_per_key_total_tiebreak(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", 1, "q")],
                               "k string, ts int, v string")
    got = sorted(tuple(r) for r in latest_per_key(df, ["k"], ["ts"]).collect())
    assert got == [("a", 2, "z"), ("b", 1, "q")]


def test_dense_ids_match_row_number(spark):
    keys = [f"k{i:05d}" for i in range(2000)]
    df = spark.createDataFrame([(k,) for k in reversed(keys)], "key string").repartition(7)
    out = assign_dense_ids(df, ["key"], start=10, num_partitions=5).collect()
    got = {r["key"]: r["id"] for r in out}
    assert got == {k: 11 + i for i, k in enumerate(keys)}


def test_cursor_tie_is_not_lost(spark):
    t = dt.datetime(2023, 1, 1, 10, 0, 0)
    docs = spark.createDataFrame([("a", "{}", t), ("b", "{}", t), ("c", "{}", t)], S.DOCUMENT)
    first = scan_cursor_ts(docs, limit=2).collect()
    bm = batch_bookmark(scan_cursor_ts(docs, limit=2), "update_ts", "object_id").collect()[0]
    second = scan_cursor_ts(docs, after=bm["last_cursor"], after_key=bm["last_key"], limit=2).collect()
    assert {r.object_id for r in first + second} == {"a", "b", "c"}
    literal = scan_cursor_ts(docs, after=bm["last_cursor"], limit=2, literal=True).collect()
    assert literal == []  # the strict '>' cursor loses the third document


def test_offset_page(spark):
    df = spark.range(0, 1000).withColumnRenamed("id", "k")
    got = [r.k for r in scan_offset_page(df, ["k"], 400, 200).collect()]
    assert got == list(range(400, 600))


def test_quarantine_bad_text(spark):
    rows = [("1", '{"_id": "r1", "name": "A", "menu": [{"_id": "p1", "name": "x", "price": 1.5}]}'),
            ("2", "not json"), ("3", '{"name": "no id"}'),
            ("4", '{"_id": "r4", "menu": [{"_id": "p", "name": "y", "price": "abc"}]}')]
    df = spark.createDataFrame(rows, "object_id string, object_value string")
    good, bad = split_parsed(df, "object_value", S.RESTAURANT_BODY, ["_id"])
    assert [r.object_id for r in good.collect()] == ["1"]
    reasons = {r.object_id: r.reason for r in bad.collect()}
    assert reasons == {"2": "not json", "3": "missing _id", "4": "not json"}


def test_empty_arrays_give_no_rows(spark):
    df = spark.createDataFrame([(1, '{"order_id": "o", "product_payments": []}')], "id long, v string")
    parsed = df.select("id", parse("v", S.BONUS_TRANSACTION_BODY).getField("product_payments").alias("p"))
    assert explode_array(parsed, "p").count() == 0


def test_non_ascii_survives_canonical_json(spark):
    df = spark.createDataFrame([("Пельменная", dt.datetime(2023, 1, 2, 3, 4, 5, 678), 1)],
                               "name string, ts timestamp_ntz, a int")
    text = df.select(canonical_json(df).alias("j")).collect()[0]["j"]
    assert json.loads(text) == {"a": 1, "name": "Пельменная", "ts": "2023-01-02 03:04:05"}
    assert list(json.loads(text)) == ["a", "name", "ts"]


def test_late_parent_pending_then_loaded_once(spark):
    rows = spark.createDataFrame([("d1", "o1"), ("d2", "o2")], "delivery_id string, order_key string")
    parents1 = spark.createDataFrame([("o1", 1)], "order_key string, id long")
    ok1, wait1 = resolve(rows, parents1, "order_key", "order_key", "id", "order_id")
    assert [r.delivery_id for r in ok1.collect()] == ["d1"]
    assert [r.delivery_id for r in wait1.collect()] == ["d2"]
    parents2 = spark.createDataFrame([("o1", 1), ("o2", 2)], "order_key string, id long")
    new_rows = rows.limit(0)
    ok2, wait2 = resolve(new_rows, parents2, "order_key", "order_key", "id", "order_id", pending=wait1)
    assert [(r.delivery_id, r.order_id) for r in ok2.collect()] == [("d2", 2)]
    assert wait2.count() == 0


def test_unknown_product_is_pending_not_zero(spark):
    ev = spark.createDataFrame([(
        5, dt.datetime(2023, 1, 1), "bonus_transaction",
        json.dumps({"order_id": "o1", "product_payments": [
            {"product_id": "pX", "price": 1, "quantity": 1, "product_cost": 1,
             "bonus_payment": 0, "bonus_grant": 0}]}))], S.BONUS_EVENT)
    orders = spark.createDataFrame([(1, "o1")], "id long, order_key string")
    products = spark.createDataFrame([(1, "p1", dt.datetime(2099, 12, 31))],
                                     "id long, product_id string, active_to timestamp_ntz")
    built = facts.fct_product_sales(ev, orders, products)
    assert built.table.count() == 0
    assert [r.product_key for r in built.pending.collect()] == ["pX"]


def test_constraint_checks(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, None, -1), (2, "b", 3)], "id int, name string, pct int")
    assert [r.id for r in checks.check_unique(df, ["id"]).collect()] == [1]
    assert [r.null_column for r in checks.check_not_null(df, ["name"]).collect()] == ["name"]
    assert [r.pct for r in checks.check_range(df, F.col("pct") >= 0).collect()] == [-1]
    parent = spark.createDataFrame([(1,)], "pid int")
    assert [r.id for r in checks.check_foreign_key(df, parent, ["id"], ["pid"]).collect()] == [2]


def test_update_replaces_order_status(spark):
    t1, t2 = dt.datetime(2023, 1, 1), dt.datetime(2023, 1, 2)
    body = {"_id": "o1", "restaurant": {"id": "r1"}, "user": {"id": "u1"},
            "update_ts": "2023-01-01 10:00:00", "ts_date": "2023-01-01 10:00:00"}
    docs = spark.createDataFrame([
        ("o1", json.dumps({**body, "final_status": "DELIVERING"}), t1),
        ("o1", json.dumps({**body, "final_status": "CLOSED"}), t2)], S.DOCUMENT)
    rest = spark.createDataFrame([(1, "r1")], "id long, restaurant_id string")
    users = spark.createDataFrame([(1, "u1")], "id long, user_id string")
    cal = dims.dim_timestamps(docs).table
    built = dims.dim_orders(docs, rest, cal, users)
    rows = built.table.collect()
    assert [(r.order_key, r.order_status) for r in rows] == [("o1", "CLOSED")]
    assert rows[0].timestamp_id == 1


def test_restaurant_menu_to_products(spark):
    docs = spark.createDataFrame([
        ("r1", json.dumps({"_id": "r1", "name": "A", "update_ts": "2023-01-01 00:00:00",
                           "menu": [{"_id": "p1", "name": "soup", "price": 2.5}]}),
         dt.datetime(2023, 1, 1, 0, 0, 0, 500)),
        ("r2", json.dumps({"_id": "r2", "name": "B", "update_ts": "2023-01-01 00:00:00", "menu": []}),
         dt.datetime(2023, 1, 1))], S.DOCUMENT)
    rest = dims.dim_restaurants(docs).table
    prods = dims.dim_products(docs, rest).table.collect()
    assert [(p.product_id, p.product_price, p.restaurant_id) for p in prods] == [("p1", Decimal("2.50000"), 1)]
    assert prods[0].active_from == dt.datetime(2023, 1, 1)


def test_close_versions_across_partitions(spark):
    from tabulark.operators.versions import close_versions
    t0 = dt.datetime(2023, 1, 1)
    rows = [("hot", t0 + dt.timedelta(hours=i)) for i in range(300)]
    rows += [("a", t0), ("a", t0 + dt.timedelta(days=1)), ("z", t0)]
    df = spark.createDataFrame(rows, "k string, active_from timestamp_ntz")
    out = close_versions(df, "k", "active_from", num_partitions=6).collect()
    got = {(r.k, r.active_from): r.active_to for r in out}
    assert len(got) == 303
    for i in range(299):
        assert got[("hot", t0 + dt.timedelta(hours=i))] == t0 + dt.timedelta(hours=i + 1)
    assert got[("hot", t0 + dt.timedelta(hours=299))] == dt.datetime(2099, 12, 31)
    assert got[("a", t0)] == t0 + dt.timedelta(days=1)
    assert got[("a", t0 + dt.timedelta(days=1))] == dt.datetime(2099, 12, 31)
    assert got[("z", t0)] == dt.datetime(2099, 12, 31)


def test_restaurant_versions(spark):
    v1 = json.dumps({"_id": "r1", "name": "Old", "update_ts": "2023-01-01 00:00:00", "menu": []})
    v2 = json.dumps({"_id": "r1", "name": "New", "update_ts": "2023-02-01 00:00:00", "menu": []})
    docs = spark.createDataFrame([("r1", v1, dt.datetime(2023, 1, 1)), ("r1", v2, dt.datetime(2023, 2, 1))],
                                 S.DOCUMENT)
    latest = dims.dim_restaurants(docs).table.collect()
    assert [(r.restaurant_name, r.active_to) for r in latest] == [("New", dt.datetime(2099, 12, 31))]
    hist = sorted(dims.dim_restaurants(docs, versions=True).table.collect(), key=lambda r: r.id)
    assert [(r.id, r.restaurant_name, r.active_to) for r in hist] == [
        (1, "Old", dt.datetime(2023, 2, 1)), (2, "New", dt.datetime(2099, 12, 31))]


def test_offset_pages_at_every_depth(spark):
    from tabulark.sources.scans import scan_offset_page
    df = spark.range(0, 1000).withColumnRenamed("id", "k").repartition(7)
    for offset in (0, 500, 990, 2000):
        got = [r.k for r in scan_offset_page(df, ["k"], offset, 20).collect()]
        assert got == list(range(1000))[offset:offset + 20]


def test_landed_pages_round_trip_and_bad_lines(spark):
    from tabulark.session import scratch_path
    from tabulark.sources.landing import land_pages, read_pages
    path = scratch_path(spark, "pages")
    page = spark.createDataFrame(
        [("o1", dt.datetime(2023, 7, 31, 23, 50), "d1", "c1", "addr", dt.datetime(2023, 8, 1, 0, 20),
          5, Decimal("10.50000"), Decimal("1.00000"))], S.DELIVERY_PAGE)
    land_pages(page, path)
    land_pages(page, path)  # the same page landed twice (replay): two lines, one key
    spark.createDataFrame([('{"order_id": "o2", "rate": "five"}',)], "value string") \
        .write.mode("append").text(path)
    good, bad = read_pages(spark, path, S.DELIVERY_PAGE)
    rows = good.collect()
    assert len(rows) == 2 and rows[0].order_ts == dt.datetime(2023, 7, 31, 23, 50)
    assert rows[0].sum == Decimal("10.50000")
    assert [r.raw_line for r in bad.collect()] == ['{"order_id": "o2", "rate": "five"}']


def test_product_versions_and_open_lookup(spark):
    def doc(price, ts):
        return ("r1", json.dumps({"_id": "r1", "name": "A", "update_ts": ts.isoformat(sep=" "),
                                  "menu": [{"_id": "p1", "name": "soup", "price": price}]}), ts)
    t1, t2 = dt.datetime(2023, 1, 1), dt.datetime(2023, 3, 1)
    docs = spark.createDataFrame([doc(2.5, t1), doc(3.0, t2)], S.DOCUMENT)
    rest = dims.dim_restaurants(docs).table
    latest = dims.dim_products(docs, rest).table.collect()
    assert [(p.product_price, p.active_from) for p in latest] == [(Decimal("3.00000"), t2)]
    hist = sorted(dims.dim_products(docs, rest, versions=True).table.collect(), key=lambda p: p.id)
    assert [(p.id, p.product_price, p.active_to) for p in hist] == [
        (1, Decimal("2.50000"), t2), (2, Decimal("3.00000"), dt.datetime(2099, 12, 31))]
