"""What a load writes and shuffles: nothing twice, nothing that nobody reads."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from tabulark import schemas as S
from tabulark.operators.dedupe import latest_per_key, newest_rows
from tabulark.plans import dims, facts
from tabulark.plans.dds import Lazy, _written
from tabulark.plans.incremental import Staging, Warehouse, run_dds
from tabulark.session import checkpoint_root, scratch_path, shuffle_partitions, size_shuffles, stored
from tabulark.sources import adapters
from tabulark.sources.landing import land_pages, read_pages
from tabulark.sources.sinks import Table, may_share, merge_insert_ignore, with_ids

T0 = dt.datetime(2023, 1, 1, 10)


def test_landed_pages_are_packed(spark):
    at = scratch_path(spark, "t-pages")
    rows = spark.range(500).select(F.col("id").cast("string").alias("_id"), F.lit("a name").alias("name"))
    land_pages(rows, at)
    names = [f for f in spark.read.text(at).inputFiles()]
    assert names and all(f.endswith(".json.gz") for f in names)
    good, bad = read_pages(spark, at, S.COURIER_PAGE, required=["_id"])
    assert good.count() == 500 and bad.count() == 0


def test_feeds_that_no_load_asks_for_stay_unbuilt(spark):
    built = []
    feeds = Lazy({n: lambda _, n=n: built.append(n) or spark.range(1) for n in ("a", "b", "c")})
    other = feeds.with_(b=spark.range(3))
    assert other["b"].count() == 3 and other["a"].count() == 1
    assert built == ["a"] and feeds["b"].count() == 1


def test_newest_rows_equal_latest_per_key(spark, monkeypatch):
    rows = [(k, i, f"v{i % 7}") for i, k in enumerate([None, "a", "b", "a", None, "c", "d", "a", "d", "d", "e"])]
    df = spark.createDataFrame([*rows, *rows[:3]], "k string, ts int, v string")
    want = sorted(map(str, latest_per_key(df, ["k"], ["ts"]).collect()))
    assert sorted(map(str, newest_rows(df, ["k"], ["ts"]).collect())) == want
    plan = newest_rows(df.filter("k in ('b', 'c', 'e')").dropDuplicates(["k"]), ["k"], ["ts"])._jdf.queryExecution()
    assert "max(struct" not in plan.optimizedPlan().toString()
    monkeypatch.setattr("tabulark.operators.dedupe.FEW_REPEATED", 1)
    assert sorted(map(str, newest_rows(df, ["k"], ["ts"]).collect())) == want


def _page(spark, rows):
    return spark.createDataFrame(rows, "k string, v int")


def test_tables_of_disjoint_loads_are_read_without_grouping(spark):
    for id_col in ("id", None):
        t = Table(spark, scratch_path(spark, "t-disjoint"))
        t.upsert(_page(spark, [("a", 1), (None, 1)]), ["k"], id_col=id_col, unique=True)
        t.upsert(_page(spark, [("b", 2)]), ["k"], id_col=id_col, unique=True)
        assert t.state().disjoint and "ggregate" not in t.read()._jdf.queryExecution().optimizedPlan().toString()
        t.upsert(_page(spark, [("a", 3), (None, 4)]), ["k"], id_col=id_col, unique=True)
        assert not t.state().disjoint
        got = {(r.k, r.v) for r in t.read().collect()}
        assert got == {("a", 3), ("b", 2), (None, 4)}
        t.compact()
        t.upsert(_page(spark, [("a", 5)]), ["k"], id_col=id_col, unique=True)
        assert {(r.k, r.v) for r in t.read().collect()} == {("a", 5), ("b", 2), (None, 4)}


def test_sales_and_waiting_lines_come_from_one_join(spark):
    kept = []

    def keep(df, name):
        kept.append(name)
        return stored(df, name)

    body = ('{"order_id":"%s","product_payments":[{"product_id":"%s","price":1,"quantity":1,'
            '"product_cost":1,"bonus_payment":0,"bonus_grant":0}]}')
    events = spark.createDataFrame(
        [(1, T0, "bonus_transaction", body % ("o1", "p1")), (2, T0, "bonus_transaction", body % ("o2", "p1")),
         (3, T0, "bonus_transaction", body % ("o1", "p2"))],
        "id long, event_ts timestamp_ntz, event_type string, event_value string")
    orders = spark.createDataFrame([(7, "o1")], "id long, order_key string")
    # Two products of one key: a line that waits for its order must not be doubled.
    products = spark.createDataFrame([(9, "p1", dt.datetime(2099, 12, 31)), (8, "p1", dt.datetime(2099, 12, 31))],
                                     "id long, product_id string, active_to timestamp_ntz")
    built = facts.fct_product_sales(events, orders, products, kept=keep)
    assert sorted((r.event_id, r.product_id, r.order_id) for r in built.table.collect()) == [(1, 8, 7), (1, 9, 7)]
    assert sorted(r.event_id for r in built.pending.collect()) == [2, 3] and kept == ["met-sales"]
    assert "Join" not in built.pending._jdf.queryExecution().optimizedPlan().toString()


def test_outbox_lines_are_dealt_once(spark):
    from tabulark.sources.driver import Tables
    t = Tables(spark, "unused")
    t.__dict__.update(
        lineitem=spark.createDataFrame([(1, 1, 5, 2.0, 10.0, 0.1, 0.2)], "l_orderkey long, l_partkey long, l_suppkey long, "
                                       "l_quantity double, l_extendedprice double, l_discount double, l_tax double"),
        part=spark.createDataFrame([(1, 3.0)], "p_partkey long, p_retailprice double"),
        supplier=spark.createDataFrame([(5,)], "s_suppkey long"), events=spark.createDataFrame([(0,)], "event_id long"),
        orders=spark.createDataFrame([(1, T0), (1, T0)], "o_orderkey long, o_orderdate timestamp_ntz"))
    out = adapters.bonus_transactions(t)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(l_orderkey") == 1 and "hashpartitioning(l_orderkey#" in plan
    assert [r.event_value for r in out.collect()] == [
        '{"order_id":"1-5","product_payments":[{"product_id":"1","price":3.00000,"quantity":2,"product_cost":10.00000,'
        '"bonus_payment":1.00000,"bonus_grant":2.00000}]}'] * 2


def _kinds_of_scratch(spark):
    return {n.rsplit("-", 1)[0] for n in os.listdir(f"{checkpoint_root(spark)}/tables")}


def test_loads_leave_no_scratch_and_clean_batches_are_written_once(spark):
    root, before = scratch_path(spark, "t-once"), _kinds_of_scratch(spark)
    stg, wh = Staging(spark, f"{root}/stg"), Warehouse(spark, f"{root}/dds")

    def docs(*rows):
        return spark.createDataFrame([(k, f'{{"_id":"{k}","login":"l","name":"{n}"}}' if k else "{}", t)
                                      for k, n, t in rows], "object_id string, object_value string, update_ts timestamp_ntz")

    later = T0 + dt.timedelta(hours=1)
    stg.land("users", docs(("a", "one", T0), ("b", "two", T0)))
    run_dds(stg, wh, only=["dm_users"])
    # A repeated key, an older row and two rejected ones: written again without them.
    stg.land("users", docs(("a", "new", later), ("a", "old", T0), (None, "x", T0), ("c", "y", None), ("d", "z", T0)))
    run_dds(stg, wh, only=["dm_users"])
    assert {(r.id, r.user_id, r.user_name) for r in wh.read("dm_users").collect()} == {
        (1, "a", "new"), (2, "b", "two"), (3, "d", "z")}
    assert sorted(r.reason for r in stg.rejected["users"].read().collect()) == ["null object_id", "null update_ts"]
    assert stg["users"].read().columns == ["object_id", "object_value", "update_ts"]
    folders = [n for n in os.listdir(f"{root}/stg/users") if n != "_pointers"]
    assert sorted(folders) == sorted(stg["users"].state().folders) and len(folders) == 2
    assert _kinds_of_scratch(spark) <= before | {"t-once"}


def _shuffles(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("Exchange hashpartitioning")


def test_order_keys_are_dealt_once(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = adapters.order_documents(adapters.Tables(spark, "/root/testdata/sf0.001"))
        assert _shuffles(docs) == 2  # keys and orders
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_month_folders_are_written_without_a_shuffle(spark):
    rows = spark.range(0, 3000, numPartitions=3).select(
        "id", F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, cast(id % 2 as int))").alias("order_ts"),
        F.spark_partition_id().alias("p"))
    out = _written(spark, rows, "t-months", ("order_month", lambda: F.trunc("order_ts", "month")))
    # Each task's rows stay its own: a file per task and month.
    files = [f.split("order_month=")[1][:10] for f in out.inputFiles()]
    assert sorted(files) == ["2024-01-01"] * 3 + ["2024-02-01"] * 3
    counts = out.groupBy("order_month").agg(F.count("*").alias("n")).collect()
    assert sorted((str(r.order_month), r.n) for r in counts) == [("2024-01-01", 1500), ("2024-02-01", 1500)]


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_order_documents_are_parsed_once_for_calendar_and_orders(spark):
    def doc(key, **body):
        return (key, json.dumps({"_id": key, "restaurant": {"id": "r"}, "user": {"id": "u"},
                                 "update_ts": "2023-01-01 10:00:00", "ts_date": "2023-01-02 10:00:00", **body}), T0)
    docs = spark.createDataFrame([doc("a", final_status="CLOSED"), doc("b", final_status="DELIVERING"),
                                  doc("c"), ("d", "{cut", T0), ("d", "{cut", T0), ("e", None, T0)], S.DOCUMENT)
    parsed = stored(dims.parsed_orders(docs), "t-parsed")
    rest = spark.createDataFrame([(1, "r")], "id long, restaurant_id string")
    users = spark.createDataFrame([(1, "u")], "id long, user_id string")
    cal = dims.dim_timestamps(docs, parsed=parsed, with_ids=False)
    days = spark.createDataFrame([(1, T0)], "id long, ts timestamp_ntz")
    orders = dims.dim_orders(docs, rest, days, users, parsed=parsed, with_ids=False)
    for df in (cal.table, cal.rejected, orders.table, orders.rejected):
        assert "from_json" not in _plan(df)
    assert [r.ts for r in cal.table.collect()] == [dt.datetime(2023, 1, 2, 10)]
    assert sorted(r.reason for r in cal.rejected.collect()) == ["not json", "not json", "null body"]
    assert sorted((r.object_id, r.reason) for r in orders.rejected.collect()) == [
        ("c", "missing final_status"), ("d", "not json"), ("d", "not json"), ("e", "null body")]
    assert orders.rejected.columns == [*docs.columns, "reason"]
    assert sorted((r.order_key, r.timestamp_id) for r in orders.table.collect()) == [("a", 1), ("b", 1)]
    once = dims.dim_timestamps(docs, with_ids=False, kept=stored)  # a load: times and rejects from one parse
    assert "from_json" not in _plan(once.table) and "from_json" not in _plan(once.rejected)
    assert [r.ts for r in once.table.collect()] == [dt.datetime(2023, 1, 2, 10)]
    assert sorted(r.reason for r in once.rejected.collect()) == ["not json", "null body"]


def test_batches_without_held_keys_are_not_joined(spark):
    held = spark.createDataFrame([(1, "a"), (2, None)], "id long, k string")
    new = spark.createDataFrame([("b", 1), ("c", 2)], "k string, v int")
    some = spark.createDataFrame([("a", 1), ("c", 2), ("c", 2), (None, 3)], "k string, v int")
    assert not may_share(new, held, ["k"]) and may_share(some, held, ["k"])
    # Equal values of two types have two hashes.
    assert may_share(spark.sql("select 1 as id"), held, ["id"]) and not may_share(new, held.limit(0), ["k"])
    assert "Join" not in _plan(merge_insert_ignore(held, new, ["k"]))
    assert "Join" not in _plan(merge_insert_ignore(held, new, ["k"], unique=True))
    assert sorted(map(str, merge_insert_ignore(held, some, ["k"]).select("k").toPandas()["k"])) == ["None", "c"]
    out = with_ids(new, held, ["k"], "id", 2)
    assert sorted((r.id, r.k, r.v) for r in out.collect()) == [(3, "b", 1), (4, "c", 2)]
    out = with_ids(some.distinct(), held, ["k"], "id", 2)
    assert sorted((r.id, str(r.k)) for r in out.collect()) == [(1, "a"), (3, "None"), (4, "c")]


def test_shuffles_begin_with_a_partition_per_rows_of_the_input(spark):
    names = ["spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes"]
    before = [spark.conf.get(n, None) for n in names]
    try:
        size_shuffles(spark, 10)
        assert shuffle_partitions(spark) == 4  # never fewer than the session's
        size_shuffles(spark, 1_000_001)
        size_shuffles(spark, 10)  # nor than an earlier input asked for
        plan = spark.range(10).select(F.expr("id % 3 AS k")).groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
        assert shuffle_partitions(spark) == 11 and "hashpartitioning(k#" in plan and ", 11)" in plan
    finally:
        for n, value in zip(names, before):
            spark.conf.unset(n) if value is None else spark.conf.set(n, value)


def test_narrow_partitions_make_no_small_files_and_no_sort_by_month(spark):
    rows = spark.range(0, 6400, numPartitions=64).select("id", F.expr(
        "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, cast(id % 2 as int))").alias("order_ts"))
    out = _written(spark, rows, "t-narrow", ("order_month", lambda: F.trunc("order_ts", "month")))
    assert len(out.inputFiles()) <= 2 * spark.sparkContext.defaultParallelism
    counts = out.groupBy("order_month").agg(F.count("*").alias("n"), F.count_distinct("id").alias("d")).collect()
    assert sorted((str(r.order_month), r.n, r.d) for r in counts) == [
        ("2024-01-01", 3200, 3200), ("2024-02-01", 3200, 3200)]
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_a_run_parses_its_order_documents_once(spark, monkeypatch):
    calls, parse = [], dims.parsed_orders
    monkeypatch.setattr(dims, "parsed_orders", lambda docs: calls.append(1) or parse(docs))
    root, before = scratch_path(spark, "t-parsed"), _kinds_of_scratch(spark)
    wh = Warehouse(spark, root)

    def docs(*rows):
        return spark.createDataFrame(
            [(k, json.dumps({"_id": k, "final_status": "CLOSED", "restaurant": {"id": "r"}, "user": {"id": "u"},
                             "ts_date": str(t), "update_ts": str(t)}), t) for k, t in rows],
            "object_id string, object_value string, update_ts timestamp_ntz")

    users = spark.createDataFrame([("u", '{"_id":"u","name":"n","login":"l"}', T0)], docs().schema)
    rest = spark.createDataFrame([("r", json.dumps({"_id": "r", "name": "n", "update_ts": str(T0), "menu": []}), T0)],
                                 docs().schema)
    only = ["dm_users", "dm_restaurants", "dm_timestamps", "dm_orders"]
    feeds = {"users": users, "restaurants": rest, "orders": docs(("a", T0), ("b", T0 + dt.timedelta(days=1)))}
    run_dds(feeds, wh, only=only)
    assert len(calls) == 1
    # The calendar of another batch than the orders' is parsed by itself.
    more = docs(("c", T0 + dt.timedelta(days=2)), ("d", T0 + dt.timedelta(days=3)))
    run_dds(feeds | {"orders": more}, wh, only=["dm_timestamps"])
    run_dds(feeds | {"orders": more}, wh, only=only)
    assert len(calls) > 2 and sorted(r.order_key for r in wh.read("dm_orders").collect()) == ["a", "b", "c", "d"]
    assert wh.read("dm_orders").filter("timestamp_id IS NULL").isEmpty()
    assert "parsed-orders" not in _kinds_of_scratch(spark) - before


def test_rejected_rows_are_told_apart_by_hash(spark, monkeypatch):
    from tabulark.plans import incremental
    plans = []

    def keep(df, name):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return stored(df, name)

    monkeypatch.setattr(incremental, "stored", keep)
    table = Table(spark, scratch_path(spark, "t-rejected"))
    bad = spark.createDataFrame([(1, "x"), (1, "x"), (1, "y"), (None, "x"), (None, "x")], "id long, reason string")
    for rows in (bad, bad.unionByName(spark.createDataFrame([(2, "x")], bad.schema))):
        incremental._store_rejected(table, rows)
    assert sorted(map(tuple, table.read().collect())) == [
        ('{"id":1}', "x"), ('{"id":1}', "y"), ('{"id":2}', "x"), ("{}", "x")]
    assert plans and not any("ggregate" in p for p in plans)  # bodies are not shuffled to find repeated ones


def test_pages_are_gzipped_at_a_fast_level(spark):
    import gzip
    at = scratch_path(spark, "t-level")
    land_pages(spark.range(20_000).selectExpr("cast(id * 7919 AS string) AS _id", "uuid() AS name").coalesce(1), at)
    packed = open(spark.read.text(at).inputFiles()[0].removeprefix("file://"), "rb").read()
    assert len(packed) > len(gzip.compress(gzip.decompress(packed)))
