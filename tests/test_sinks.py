"""Sinks: replay, upsert with kept ids and order, insert-ignore, pointers, batch splits."""

import pytest
from pyspark.sql import functions as F

from tabulark.session import scratch_path
from tabulark.sources.sinks import Table, merge_upsert, sink_append, sink_insert_ignore, sink_upsert


def _page(spark, rows):
    return spark.createDataFrame(rows, "courier_id string, name string, ts int")


def _table(spark):
    return Table(spark, scratch_path(spark, "t-table"))


def test_replayed_page_changes_nothing(spark):
    t = _table(spark)
    page = _page(spark, [("c1", "Anna", 1), ("c2", "Boris", 1)])
    first = sorted(tuple(r) for r in sink_upsert(t, page, ["courier_id"], ["ts"], id_col="id").collect())
    again = sorted(tuple(r) for r in sink_upsert(t, page, ["courier_id"], ["ts"], id_col="id").collect())
    assert first == again
    assert t.state().version == 2


def test_upsert_keeps_ids_and_numbers_new_keys(spark):
    t = _table(spark)
    sink_upsert(t, _page(spark, [("c2", "B", 1), ("c1", "A", 1)]), ["courier_id"], ["ts"], id_col="id")
    out = sink_upsert(t, _page(spark, [("c1", "A2", 2), ("c0", "Z", 2)]), ["courier_id"], ["ts"], id_col="id")
    got = {r.courier_id: (r.id, r.name) for r in out.collect()}
    assert got == {"c1": (1, "A2"), "c2": (2, "B"), "c0": (3, "Z")}
    assert t.max_id() == 3


def test_an_older_row_that_comes_later_never_wins(spark):
    t = _table(spark)
    sink_upsert(t, _page(spark, [("c1", "new", 5)]), ["courier_id"], ["ts"], id_col="id")
    out = sink_upsert(t, _page(spark, [("c1", "old", 2)]), ["courier_id"], ["ts"], id_col="id")
    assert [(r.id, r.name) for r in out.collect()] == [(1, "new")]
    a, b = _page(spark, [("c1", "new", 5)]), _page(spark, [("c1", "old", 2), ("c2", "x", 1)])
    assert {r.courier_id: r.name for r in merge_upsert(a, b, ["courier_id"], ["ts"]).collect()} == {
        "c1": "new", "c2": "x"}
    assert [r.name for r in merge_upsert(b.filter("courier_id = 'c1'"), a, ["courier_id"]).collect()] == ["new"]


def test_insert_ignore_and_append(spark):
    t = _table(spark)
    sink_insert_ignore(t, _page(spark, [("c1", "A", 1)]), ["courier_id"])
    out = sink_insert_ignore(t, _page(spark, [("c1", "changed", 2), ("c2", "B", 2)]), ["courier_id"])
    assert sorted((r.courier_id, r.name) for r in out.collect()) == [("c1", "A"), ("c2", "B")]
    a = _table(spark)
    sink_append(a, _page(spark, [("c1", "A", 1)]))
    assert sink_append(a, _page(spark, [("c1", "A", 1)])).count() == 2


def test_append_and_insert_ignore_keep_an_upserted_table(spark):
    t = _table(spark)
    rows = [(f"c{i}", "x", 1) for i in range(100)]
    sink_upsert(t, _page(spark, rows), ["courier_id"], ["ts"])
    assert sink_insert_ignore(t, _page(spark, [("c5", "y", 9), ("n", "z", 1)]).withColumn("_load", F.lit(0)),
                              ["courier_id"]).count() == 101


def test_bookmark_moves_with_data_and_stays(spark):
    t = _table(spark)
    sink_upsert(t, _page(spark, [("c1", "A", 1)]), ["courier_id"], bookmark={"offset": 1})
    assert t.bookmark() == {"offset": 1}
    sink_upsert(t, _page(spark, [("c2", "B", 1)]), ["courier_id"])
    assert t.bookmark() == {"offset": 1}  # a call without a bookmark erases none


def test_of_two_writers_that_began_together_one_fails(spark):
    t = _table(spark)
    sink_append(t, _page(spark, [("c1", "A", 1)]))
    begun = t.state()
    folder = t._land(_page(spark, [("c2", "B", 1)]))
    sink_append(t, _page(spark, [("c3", "C", 1)]))  # another writer is first
    with pytest.raises(Exception, match="exist"):
        t.publish(begun, folders=[*begun.folders, folder])
    assert sorted(r.courier_id for r in t.read().collect()) == ["c1", "c3"]


def test_an_unfinished_pointer_is_not_seen(spark):
    t = _table(spark)
    sink_append(t, _page(spark, [("c1", "A", 1)]))
    from tabulark.sources.sinks import _fs
    fs, p = _fs(spark, f"{t.root}/_pointers/.crashed")
    fs.create(p, False).close()
    assert t.read().count() == 1 and t.state().version == 1


def test_one_batch_equals_two_batches(spark):
    rows = [(f"c{i % 37}", f"n{i}", i) for i in range(300)]
    df = _page(spark, rows)
    a = sink_upsert(_table(spark), df, ["courier_id"], ["ts"])
    two = _table(spark)
    sink_upsert(two, df.filter(F.col("ts") < 150), ["courier_id"], ["ts"])
    b = sink_upsert(two, df.filter(F.col("ts") >= 150), ["courier_id"], ["ts"])
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_compact_keeps_rows_ids_and_bookmark(spark):
    t = _table(spark)
    for i in range(3):
        sink_upsert(t, _page(spark, [(f"c{i}", "x", i), ("c0", f"v{i}", i)]), ["courier_id"], ["ts"], id_col="id",
                    bookmark={"run": i})
    before = sorted(map(tuple, t.read().collect()))
    assert len(t.state().folders) == 3
    t.compact()
    assert len(t.state().folders) == 1
    assert sorted(map(tuple, t.read().collect())) == before and t.bookmark() == {"run": 2}
    out = sink_upsert(t, _page(spark, [("c0", "late", 1), ("c9", "n", 1)]), ["courier_id"], ["ts"], id_col="id")
    got = {r.courier_id: (r.id, r.name) for r in out.collect()}
    assert got["c0"] == (1, "v2") and got["c9"][0] == 4


def test_bookmark_helpers(spark):
    from tabulark.sources import bookmarks as B
    bm = spark.createDataFrame([("wf-a", '{"last_id": 7}')], "workflow_key string, workflow_settings string")
    keys = spark.createDataFrame([("wf-a",), ("wf-new",)], "workflow_key string")
    got = {r.workflow_key: r.value for r in B.read_setting(bm, "last_id", default=B.START_ID, keys=keys).collect()}
    assert got == {"wf-a": "7", "wf-new": "-1"}
    batch = spark.createDataFrame([(3,), (9,)], "id long")
    assert tuple(B.advance_max(batch, "id", "last_id", previous=7).collect()[0]) == (9, 2)
    empty = batch.filter("id > 100")
    assert tuple(B.advance_max(empty, "id", "last_id", previous=7).collect()[0]) == (7, 0)
    assert tuple(B.advance_offset(batch, previous=200).collect()[0]) == (202, 2)
    update = bm.select("workflow_key", B.settings_json(last_id=F.lit(9)).alias("workflow_settings"))
    saved = B.save_settings(bm, update)
    assert [tuple(r) for r in saved.collect()] == [("wf-a", '{"last_id":9}')]
