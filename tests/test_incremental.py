"""Incremental loads: bookmark, idempotent reruns, late parents, rejects, crashes."""

import datetime as dt
import json

import pytest

from tabulark import schemas as S
from tabulark.plans import dims, facts
from tabulark.plans.incremental import Staging, Warehouse, run_dds, run_increment, run_stg
from tabulark.session import scratch_path
from tabulark.sources.sinks import Table

T0 = dt.datetime(2023, 1, 1, 10)


def _doc(key, user, ts, status="CLOSED", day=T0):
    body = {"_id": key, "final_status": status, "restaurant": {"id": "r1"}, "user": {"id": user},
            "update_ts": day.isoformat(sep=" "), "ts_date": day.isoformat(sep=" ")}
    return (key, json.dumps(body), ts)


def _tables(spark):
    root = scratch_path(spark, "t-inc")
    return Table(spark, f"{root}/t"), Table(spark, f"{root}/p"), Table(spark, f"{root}/r")


class Parents:
    def __init__(self, spark, users=("u1",), days=(T0,)):
        self.spark = spark
        self.rest = spark.createDataFrame([(1, "r1")], "id long, restaurant_id string")
        self.set(users, days)

    def set(self, users, days):
        self.users = self.spark.createDataFrame([(i + 1, u) for i, u in enumerate(users)], "id long, user_id string")
        self.days = self.spark.createDataFrame([(i + 1, d) for i, d in enumerate(days)], "id long, ts timestamp_ntz")

    def build(self, batch, waiting):
        return dims.dim_orders(batch, self.rest, self.days, self.users, pending=waiting, with_ids=False)


def _run(docs, target, parents, pending, rejected, **more):
    return run_increment(docs, target, parents.build, "order_key", pending, rejected, order_by=["update_ts"], **more)


def _hours(n):
    return T0 + dt.timedelta(hours=n)


def test_runs_bookmark_pending_and_rerun(spark):
    docs = spark.createDataFrame([_doc("o1", "u1", T0), _doc("o2", "u2", T0), _doc("o3", "u1", _hours(1))], S.DOCUMENT)
    target, pending, rejected = _tables(spark)
    parents = Parents(spark)
    assert _run(docs, target, parents, pending, rejected, limit=2) == 2
    assert [r.order_key for r in target.read().collect()] == ["o1"]
    assert [r.order_key for r in pending.read().collect()] == ["o2"]  # user u2 not loaded yet
    parents.set(("u1", "u2"), (T0,))
    assert _run(docs, target, parents, pending, rejected, limit=2) == 1
    assert {r.order_key: r.id for r in target.read().collect()} == {"o1": 1, "o2": 2, "o3": 3}
    assert pending.read().count() == 0
    assert _run(docs, target, parents, pending, rejected, limit=2) == 0
    assert target.bookmark()["cursor"].startswith("2023-01-01 11:00:00")


def test_a_newer_document_beats_a_waiting_one(spark):
    """The order waits as DELIVERING, is loaded as CLOSED, then its old parent comes."""
    target, pending, rejected = _tables(spark)
    parents = Parents(spark)
    first = spark.createDataFrame([_doc("o1", "u2", T0, "DELIVERING")], S.DOCUMENT)
    both = spark.createDataFrame([_doc("o1", "u2", T0, "DELIVERING"), _doc("o1", "u1", _hours(2))], S.DOCUMENT)
    _run(first, target, parents, pending, rejected)
    assert pending.read().count() == 1
    _run(both, target, parents, pending, rejected)
    parents.set(("u1", "u2"), (T0,))
    _run(both, target, parents, pending, rejected)
    assert [(r.order_key, r.order_status) for r in target.read().collect()] == [("o1", "CLOSED")]
    # The same when the old row resolves only after the newer one was loaded.
    target, pending, rejected = _tables(spark)
    target.upsert(parents.build(spark.createDataFrame([_doc("o1", "u1", _hours(2))], S.DOCUMENT), None).table,
                  ["order_key"], ["update_ts"], "id")
    _run(first, target, parents, pending, rejected)
    assert [(r.id, r.order_status) for r in target.read().collect()] == [(1, "CLOSED")]


def test_an_order_waits_for_its_calendar_row(spark):
    docs = spark.createDataFrame([_doc("o1", "u1", T0), _doc("o2", "u1", T0, "DELIVERING")], S.DOCUMENT)
    target, pending, rejected = _tables(spark)
    parents = Parents(spark, days=())
    _run(docs, target, parents, pending, rejected)
    assert [(r.order_key, r.timestamp_id) for r in target.read().collect()] == [("o2", None)]
    parents.set(("u1",), (T0,))
    _run(docs, target, parents, pending, rejected)
    assert {r.order_key: r.timestamp_id for r in target.read().collect()} == {"o1": 1, "o2": None}


def test_rejected_rows_are_kept_once(spark):
    good, bad = _doc("o1", "u1", T0), ("o2", "{broken", _hours(1))
    docs = spark.createDataFrame([good, bad], S.DOCUMENT)
    target, pending, rejected = _tables(spark)
    parents = Parents(spark)
    assert _run(docs, target, parents, pending, rejected) == 2
    rows = rejected.read().collect()
    assert [r.reason for r in rows] == ["not json"] and json.loads(rows[0].body)["object_id"] == "o2"
    target, _, _ = _tables(spark)  # the run crashed before its bookmark: all again
    _run(docs, target, parents, pending, rejected)
    assert rejected.read().count() == 1


def test_a_crash_before_the_bookmark_loses_no_waiting_row(spark, monkeypatch):
    docs = spark.createDataFrame([_doc("o1", "u2", T0)], S.DOCUMENT)
    more = spark.createDataFrame([_doc("o1", "u2", T0), _doc("o2", "u3", _hours(1))], S.DOCUMENT)
    target, pending, rejected = _tables(spark)
    parents = Parents(spark)
    _run(docs, target, parents, pending, rejected)
    parents.set(("u1", "u2"), (T0,))
    upsert = Table.upsert
    monkeypatch.setattr(Table, "upsert", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        _run(more, target, parents, pending, rejected)
    monkeypatch.setattr(Table, "upsert", upsert)
    _run(more, target, parents, pending, rejected)
    assert [r.order_key for r in target.read().collect()] == ["o1"]
    assert [r.order_key for r in pending.read().collect()] == ["o2"]


def test_a_rating_out_of_range_is_rejected(spark):
    rows = [("d1", "o1", T0, "c1", 5, 1.0, 0.0), ("d2", "o1", T0, "c1", 10, 1.0, 0.0), ("d3", "o1", None, "c1", 4, 1.0, 0.0)]
    feed = spark.createDataFrame(rows, "delivery_id string, order_id string, order_ts timestamp_ntz, courier_id string, "
                                       "rate int, sum double, tip_sum double")
    orders = spark.createDataFrame([(1, "o1")], "id long, order_key string")
    couriers = spark.createDataFrame([(1, "c1")], "id long, courier_id string")
    built = facts.fct_deliveries(feed, orders, couriers)
    assert [r.delivery_id for r in built.table.collect()] == ["d1"]
    assert {(r.delivery_id, r.rate, r.reason) for r in built.rejected.collect()} == {
        ("d2", 10, "rating out of range"), ("d3", 4, "missing order_ts")}


def test_versions_open_only_on_a_change(spark):
    from pyspark.sql import functions as F

    def doc(key, name, hours):
        body = {"_id": key, "name": name, "menu": [], "update_ts": _hours(hours).isoformat(sep=" ")}
        return (key, json.dumps(body), _hours(hours))

    docs = spark.createDataFrame([doc("r1", "A", 0), doc("r1", "A", 1), doc("r1", "B", 2), doc("r1", "A", 3),
                                  doc("r2", "A", 3)], S.DOCUMENT)
    rows = dims.dim_restaurants(docs, versions=True).table.orderBy("restaurant_id", "active_from").collect()
    assert [(r.restaurant_id, r.restaurant_name, r.active_from.hour) for r in rows] == [
        ("r1", "A", 10), ("r1", "B", 12), ("r1", "A", 13), ("r2", "A", 13)]
    assert rows[0].active_to == rows[1].active_from and F is not None


def test_stg_runs_follow_the_cursor(spark):
    feed = spark.createDataFrame([_doc(f"o{i}", "u1", _hours(i // 3)) for i in range(10)], S.DOCUMENT)
    table = Table(spark, scratch_path(spark, "t-stg"))
    assert [run_stg(feed, table, limit=4) for _ in range(4)] == [4, 4, 2, 0]  # cuts through equal times
    assert table.read().count() == 10


def test_whole_runs_reach_the_full_load(spark):
    from conftest import SF0001
    from tabulark import catalog
    from tabulark.plans.dds import materialized_stg
    stg = materialized_stg(spark, SF0001)
    wh = Warehouse(spark, scratch_path(spark, "t-wh"))
    taken = run_dds(stg, wh)
    assert all(taken.values())
    full = catalog.dds(spark, SF0001)
    for name in wh.target:
        rows = wh.read(name)
        want = full[name].select(*rows.columns) if name != "fct_deliveries" else full[name].drop("order_month")
        assert rows.select(*want.columns).exceptAll(want).isEmpty() and rows.count() == want.count(), name
        assert wh.pending[name].read() is None or wh.pending[name].read().isEmpty()


DELIVERY = ("delivery_id string, order_id string, order_ts timestamp_ntz, courier_id string, "
            "delivery_ts timestamp_ntz, rate int, sum double, tip_sum double")


def test_deliveries_are_taken_by_arrival(spark):
    """Late, corrected, null-time and waiting deliveries: the last to arrive stands."""
    root = scratch_path(spark, "t-arrival")
    stg = Staging(spark, f"{root}/stg")
    target, pending, rejected = _tables(spark)
    parents = {"orders": [(1, "o1")]}

    def build(batch, waiting):
        orders = spark.createDataFrame(parents["orders"], "id long, order_key string")
        couriers = spark.createDataFrame([(1, "c1")], "id long, courier_id string")
        return facts.fct_deliveries(batch, orders, couriers, pending=waiting)

    def load(*rows):
        stg.land("deliveries", spark.createDataFrame(
            [(d, o, T0, "c1", ts, rate, 1.0, 0.0) for d, o, ts, rate in rows], DELIVERY))
        return run_increment(stg["deliveries"], target, build, "delivery_id", pending, rejected,
                             order_by=["arrived"], id_col=None)

    def rates(table):
        return {r.delivery_id: None if r.rate is None else int(r.rate) for r in table.read().collect()}

    assert load(("d1", "o1", _hours(5), 3), ("w", "o2", _hours(5), 5), (None, "o1", T0, 1)) == 2
    assert rates(target) == {"d1": 3} and rates(pending) == {"w": 5}
    assert [r.reason for r in stg.rejected["deliveries"].read().collect()] == ["null delivery_id"]
    assert load(("d1", "o1", _hours(5), 5), ("late", "o1", _hours(-9), 4), ("none", "o1", None, 2),
                ("w", "o2", _hours(5), 3)) == 4  # the waiting one is corrected downwards
    assert rates(target) == {"d1": 5, "late": 4, "none": 2} and rates(pending) == {"w": 3}
    parents["orders"].append((2, "o2"))
    stg["deliveries"].compact()  # folds folders: nothing arrives by it
    assert run_increment(stg["deliveries"], target, build, "delivery_id", pending, rejected,
                         order_by=["arrived"], id_col=None) == 0
    assert rates(target) == {"d1": 5, "late": 4, "none": 2, "w": 3} and rates(pending) == {}
    assert load(("d1", "o1", T0, 1)) == 1 and rates(target)["d1"] == 1


def test_arrivals_open_late_folders_alone(spark):
    table = Table(spark, scratch_path(spark, "t-folders"))
    for n in range(3):
        table.upsert(spark.createDataFrame([(n, n)], "k int, v int"), ["k"])
    late = table.arrivals(2)
    assert [(r.k, r.arrived) for r in late.collect()] == [(2, 3)] and len(late.inputFiles()) == 1
    table.compact()
    assert {(r.k, r.arrived) for r in table.arrivals(1).collect()} == {(1, 2), (2, 3)}
    assert table.arrivals(3).count() == 0


def test_null_cursors_are_rejected(spark):
    target, pending, rejected = _tables(spark)
    parents = Parents(spark)
    docs = spark.createDataFrame([_doc("o1", "u1", T0)], S.DOCUMENT)
    from pyspark.sql import functions as F
    untimed = spark.createDataFrame([_doc("o2", "u1", T0)], S.DOCUMENT).withColumn(
        "update_ts", F.lit(None).cast("timestamp_ntz"))
    assert _run(docs, target, parents, pending, rejected) == 1
    for _ in range(2):
        assert _run(docs.unionByName(untimed), target, parents, pending, rejected) == 0
    assert [(r.reason, json.loads(r.body)["object_id"]) for r in rejected.read().collect()] == [("null update_ts", "o2")]


def test_stg_constraints_gate_the_load(spark):
    feed = spark.createDataFrame([(1, 5), (2, -1), (None, 3), (4, None)], "id long, percent int")
    table, bad = Table(spark, scratch_path(spark, "t-gate")), Table(spark, scratch_path(spark, "t-gate-bad"))
    assert [run_stg(feed, table, "id", "id", 2, bad, ("percent",)) for _ in range(3)] == [2, 1, 0]
    assert sorted(r.id for r in table.read().collect()) == [1, 4]
    assert {(r.reason, r.body) for r in bad.read().collect()} == {
        ("null id", '{"percent":3}'), ("negative percent", '{"id":2,"percent":-1}')}
    with pytest.raises(ValueError):
        run_stg(feed, Table(spark, scratch_path(spark, "t-gate2")), "id", "id", not_negative=("percent",))


def test_a_stream_keeps_bad_lines_and_skips_published_epochs(spark, tmp_path):
    from pyspark.sql import types as T
    from tabulark.streaming import ingest
    table, bad = Table(spark, scratch_path(spark, "t-str")), Table(spark, scratch_path(spark, "t-str-bad"))
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.LongType())])
    drop, point = tmp_path / "drop", str(tmp_path / "point")
    drop.mkdir()

    def run(checkpoint=point):
        return ingest.ingest_landed(spark, str(drop), schema, table, ["k"], ["v"], checkpoint, rejected=bad)

    (drop / "a.json").write_text('{"k": 1, "v": 1}\n{"k": 2, "v"\n{"v": 7}\n')
    assert [(r.k, r.v) for r in run().collect()] == [(1, 1)]
    assert {(r.reason, r.body) for r in bad.read().collect()} == {("not parsed", '{"k": 2, "v"'), ("null k", '{"v":7}')}
    folders = table.state().folders
    for f in sorted((tmp_path / "point" / "commits").iterdir()):  # crashed before the commit was written
        f.rename(tmp_path / f.name)
    run()
    assert table.state().folders == folders and bad.read().count() == 2
    run(str(tmp_path / "other"))  # another stream numbers its epochs anew
    assert len(table.state().folders) == len(folders) + 1
