"""Incremental loads: cursor scan -> build rows -> upsert -> bookmark.

One run takes the stg rows past the bookmark, builds the batch's rows with the same
builders as a full load, and writes them with the new bookmark in one pointer.
From a stg table (``Staging``) it takes what arrived since: the folders of the
loads after the bookmark's, so late, corrected and repeated rows are taken whatever
time they carry.  From a plain DataFrame, which tells no arrival, it scans by time
and key (a pair, so ties at a cut are not lost).  Nothing is lost on the way:

* rows that break a constraint of their feed are rejected before stg is published,
  and rows without a cursor value when they are scanned;
* rejected rows are stored first, each once (a repeated run adds nothing);
* rows that wait for a parent are added to the pending table before the bookmark
  moves, and taken out only after the target holds them, so a crash at any
  point leaves every row in the feed, the pending table or the target;
* a waiting row meets newer rows of its key in the next run's batch and in the
  target, and the newest wins by the order columns.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import ts_lit
from ..operators.checks import tag_violations
from ..operators.dedupe import newest_rows
from ..session import PACKED, delete_folder, dropping_scratch, scratch_path, stored
from ..sources.scans import batch_bookmark, scan_cursor_ts
from ..sources.sinks import ARRIVED, LOAD, REASON, Table
from . import dims, facts
from .dims import Built


def _cursor_value(bm: dict):
    v = bm.get("cursor")
    if v is None:
        return None
    return _dt.datetime.fromisoformat(v) if bm.get("cursor_kind") == "ts" else v


def _store_rejected(rejected: Table, *bad: DataFrame | None) -> None:
    """Keep each rejected row once: body (the row as JSON) and reason."""
    rows = None
    for one in bad:
        if one is not None:
            rest = [c for c in one.columns if c not in ("reason", ARRIVED)]
            one = one.select(F.to_json(F.struct(*rest)).alias("body"), "reason")
            rows = one if rows is None else rows.unionByName(one)
    if rows is not None:
        keys = ["body", "reason"]
        rejected.insert_ignore(newest_rows(stored(rows, "rejected"), keys, None), keys, unique=True)


def _uncursored(feed: DataFrame, cursor_col: str) -> DataFrame:
    """Rows that no cursor reaches, with the reason."""
    return feed.filter(F.col(cursor_col).isNull()).withColumn("reason", F.lit(f"null {cursor_col}"))


def run_increment(stg: DataFrame | Table, target: Table, build: Callable[[DataFrame, DataFrame | None], Built],
                  key: str | list[str], pending: Table, rejected: Table, until=None,
                  limit: int | None = None, cursor_col: str | None = "update_ts",
                  key_col: str | None = "object_id", until_col: str | None = None,
                  order_by: list[str] | None = None, id_col: str | None = "id",
                  mode: str = "upsert", unique: bool = False) -> int:
    """One incremental run; returns the number of source rows taken.

    ``build(batch, waiting)`` returns the rows for ``target``, those that wait and
    those rejected.  Of a stg table the rows of loads after the bookmark's are
    taken (S9).  Of a DataFrame the cursor is ``(cursor_col, key_col)``: a timestamp
    pair for documents, an increasing id (``key_col=None``), or None for a feed
    without arrival order, which is read whole; rows with a null cursor are
    rejected.  Waiting rows are retried even
    when the source has nothing new.  ``order_by`` names the target's columns
    that tell a newer row; ``mode="insert_ignore"`` (facts, S15) adds only rows
    whose key is absent; ``unique`` says that ``build`` gives one row per key.
    """
    bm = target.bookmark() or {}
    lost = None
    if isinstance(stg, Table):
        if until is not None or limit is not None:
            raise ValueError("a stg table is taken by whole loads, without until or limit")
        at = stg.state()
        batch = stg.arrivals(bm.get("load", 0), at)
        if batch is None:
            return 0
        taken = batch.count()
        bookmark = {"load": at.version, "rows": taken}
    elif cursor_col is None:
        batch = stg if until is None else stg.filter(F.col(until_col) < ts_lit(until))
        taken, bookmark = batch.count(), {}
    else:
        lost = _uncursored(stg, cursor_col)
        batch = stg.filter(F.col(cursor_col).isNotNull())
        batch = batch if until is None else batch.filter(F.col(until_col or cursor_col) < ts_lit(until))
        batch = scan_cursor_ts(batch, cursor_col, key_col, after=_cursor_value(bm),
                               after_key=bm.get("key"), limit=limit)
        found = batch_bookmark(batch, cursor_col, key_col).collect()[0]
        taken, bookmark = int(found["batch_rows"]), bm
        if taken:
            last = found["last_cursor"]
            is_ts = isinstance(last, _dt.datetime)
            bookmark = {"cursor": last.isoformat(sep=" ") if is_ts else last,
                        "cursor_kind": "ts" if is_ts else "value",
                        "key": found["last_key"] if key_col else None, "rows": taken}
    waiting = pending.read()
    if not taken and (waiting is None or waiting.isEmpty()):
        if lost is not None and not lost.isEmpty():
            _store_rejected(rejected, lost)
        return 0
    with dropping_scratch(target.spark):  # table, waiting and rejected rows are all written
        built = build(batch, waiting)
        _store_rejected(rejected, built.rejected, lost)
        alone = None if built.pending is None else pending.add_first(built.pending)
        keys = [key] if isinstance(key, str) else list(key)
        if mode == "insert_ignore":
            target.insert_ignore(built.table, keys, bookmark)
        else:
            target.upsert(built.table, keys, order_by, id_col, bookmark, unique)
    if alone is not None:
        alone()
    return taken


# --- a whole run of the detail layer ------------------------------------------------

@dataclass(frozen=True)
class Load:
    """How one dds table is loaded from its feed."""
    feed: str
    key: list[str]
    order_by: list[str] | None = None
    cursor: tuple[str | None, str | None] = ("update_ts", "object_id")
    until_col: str | None = None  # arrival time that ``until`` cuts; None: never cut
    id_col: str | None = "id"
    mode: str = "upsert"
    arrival_order: list[str] | None = None  # in place of order_by, from a stg table


# In build order.
LOADS = {
    "dm_couriers": Load("couriers", ["courier_id"], cursor=(None, None)),
    "dm_users": Load("users", ["user_id"], ["update_ts"]),
    "dm_restaurants": Load("restaurants", ["restaurant_id"], ["update_ts"]),
    "dm_timestamps": Load("orders", ["ts"], until_col="update_ts"),
    "dm_products": Load("restaurants", ["product_id"], ["active_from"]),
    "dm_orders": Load("orders", ["order_key"], ["update_ts"], until_col="update_ts",
                      arrival_order=["update_ts", ARRIVED]),
    "fct_product_sales": Load("events", ["event_id", "position"], cursor=("id", None),
                              id_col=None, mode="insert_ignore"),
    "fct_deliveries": Load("deliveries", ["delivery_id"], ["order_ts"],
                           cursor=("delivery_ts", "delivery_id"), until_col="delivery_ts", id_col=None,
                           arrival_order=[ARRIVED]),
}


class Warehouse:
    """Target, pending and rejected table of every dds table under one root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.target = {n: Table(spark, f"{root}/{n}") for n in LOADS}
        self.pending = {n: Table(spark, f"{root}/{n}-pending") for n in LOADS}
        self.rejected = {n: Table(spark, f"{root}/{n}-rejected") for n in LOADS}

    def read(self, name: str) -> DataFrame:
        rows = self.target[name].read()
        return rows.drop("update_ts", ARRIVED)


class _ParsedOrders:
    """Order documents with their fields, parsed and stored once for the calendar and
    the orders of a run, where both take the same batch of a feed."""

    def __init__(self, spark: SparkSession):
        self.spark, self.batch, self.path = spark, None, None

    def of(self, batch: DataFrame) -> DataFrame:
        if self.batch is None or not self.batch.sameSemantics(batch):
            self.drop()
            self.docs, self.path = dims.parsed_orders(batch), scratch_path(self.spark, "parsed-orders")
            self.docs.write.options(**PACKED).parquet(self.path)
            self.batch = batch
        return self.spark.read.schema(self.docs.schema).parquet(self.path)

    def drop(self) -> None:
        if self.path is not None:
            delete_folder(self.spark, self.path)
        self.batch = self.path = None


def _builders(wh: Warehouse, parsed: Callable[[DataFrame], DataFrame | None]) -> dict[str, Callable]:
    t = wh.read
    return {
        "dm_couriers": lambda b, w: dims.dim_couriers(b, with_ids=False),
        "dm_users": lambda b, w: dims.dim_users(b, with_ids=False),
        "dm_restaurants": lambda b, w: dims.dim_restaurants(b, with_ids=False),
        "dm_timestamps": lambda b, w: dims.dim_timestamps(b, with_ids=False, kept=stored, parsed=parsed(b)),
        "dm_products": lambda b, w: dims.dim_products(b, t("dm_restaurants"), pending=w, with_ids=False,
                                                      kept=stored),
        "dm_orders": lambda b, w: dims.dim_orders(b, t("dm_restaurants"), t("dm_timestamps"), t("dm_users"),
                                                  pending=w, with_ids=False, kept=stored, parsed=parsed(b)),
        "fct_product_sales": lambda b, w: facts.fct_product_sales(b, t("dm_orders"), t("dm_products"), pending=w,
                                                                   kept=stored),
        "fct_deliveries": lambda b, w: facts.fct_deliveries(b, t("dm_orders"), t("dm_couriers"), pending=w,
                                                             kept=stored),
    }


def run_dds(stg: dict[str, DataFrame | Table], wh: Warehouse, until=None,
            only: list[str] | None = None) -> dict[str, int]:
    """One incremental run of all dds tables (or ``only`` some), in build order;
    source rows taken per table.  ``until`` cuts the feeds that arrive over time."""
    shared, taken = _ParsedOrders(wh.spark), {}
    both = only is None or {"dm_timestamps", "dm_orders"} <= set(only)
    builders = _builders(wh, shared.of if both else lambda batch: None)
    try:
        for name, load in LOADS.items():
            if only is not None and name not in only:
                continue
            feed = stg[load.feed]
            order_by = load.arrival_order or load.order_by if isinstance(feed, Table) else load.order_by
            taken[name] = run_increment(
                feed, wh.target[name], builders[name], load.key, wh.pending[name], wh.rejected[name],
                until=until if load.until_col else None, until_col=load.until_col, cursor_col=load.cursor[0],
                key_col=load.cursor[1], order_by=order_by, id_col=load.id_col, mode=load.mode,
                unique=True)  # builders take the newest row per key, and parents hold one row each
            if name == "dm_orders":
                shared.drop()
    finally:
        shared.drop()
    return taken


# --- stg tables ---------------------------------------------------------------------

@dataclass(frozen=True)
class Feed:
    """Key and declared constraints of one stg table.  ``order_by`` tells the newer
    row of a key; without, the last to arrive is the newer."""
    key: str
    order_by: list[str] | None = None
    not_negative: tuple[str, ...] = ()

    @property
    def not_null(self) -> list[str]:
        return [self.key, *[c for c in self.order_by or [] if c != self.key]]


FEEDS = {
    "orders": Feed("object_id", ["update_ts"]),
    "restaurants": Feed("object_id", ["update_ts"]),
    "users": Feed("object_id", ["update_ts"]),
    "events": Feed("id"),
    "couriers": Feed("_id"),
    "deliveries": Feed("delivery_id"),
    "ranks": Feed("id", not_negative=("bonus_percent", "min_payment_threshold")),
    "bonus_users": Feed("id"),
}


def _land(batch: DataFrame, feed: Feed, table: Table, rejected: Table | None, bookmark: dict | None = None) -> None:
    """The batch's rows that keep the feed's constraints into ``table``, after the
    others into ``rejected``.  The batch is evaluated and written once, tagged with the
    reason, as the table's next load; only where it holds rejected rows or repeated keys
    are the rows that stay written again."""
    begun = table.state()
    tagged = tag_violations(batch, feed.not_null, list(feed.not_negative)).withColumnRenamed("reason", REASON)
    with dropping_scratch(table.spark):
        folder = table.land_load(tagged, begun)
        landed = table.spark.read.parquet(f"{table.root}/{folder}").drop(LOAD)
        bad = landed.filter(F.col(REASON).isNotNull()).withColumnRenamed(REASON, "reason")
        clean = bad.isEmpty()
        if rejected is not None:
            _store_rejected(rejected, bad)
        elif not clean:
            raise ValueError("rows break constraints of the feed and no rejected table is given")
        rows = landed.filter(F.col(REASON).isNull()).drop(REASON)
        good = newest_rows(rows, [feed.key], feed.order_by)
        if not clean or good is not rows:
            first, folder = folder, table.land_load(good, begun)
            delete_folder(table.spark, f"{table.root}/{first}")
    table.publish_load(folder, begun, [feed.key], feed.order_by, bookmark=bookmark)


class Staging(dict):
    """stg tables by feed name under one root, each beside its rejected rows.
    ``run_dds`` takes it as its feeds and reads what arrived since its last run."""

    def __init__(self, spark: SparkSession, root: str):
        super().__init__({name: Table(spark, f"{root}/{name}") for name in FEEDS})
        self.rejected = {name: Table(spark, f"{root}/{name}-rejected") for name in FEEDS}

    def land(self, name: str, batch: DataFrame) -> None:
        """One load: whatever the source handed over, in any order of time."""
        _land(batch, FEEDS[name], self[name], self.rejected[name])


def run_stg(source: DataFrame, table: Table, key: str = "object_id", cursor_col: str = "update_ts",
            limit: int | None = None, rejected: Table | None = None, not_negative: tuple[str, ...] = ()) -> int:
    """One incremental load of a source feed into its stg table (S1-S6, S12,
    S13): rows past the bookmark, upserted by key, newest ``cursor_col`` wins.
    Rows that break a constraint, and rows that no cursor reaches, go to ``rejected``."""
    bm = table.bookmark() or {}
    key_col = key if cursor_col != key else None
    if rejected is not None:
        lost = _uncursored(source, cursor_col)
        if not lost.isEmpty():
            _store_rejected(rejected, lost)
    batch = scan_cursor_ts(source.filter(F.col(cursor_col).isNotNull()), cursor_col, key_col, after=_cursor_value(bm),
                           after_key=bm.get("key"), limit=limit)
    found = batch_bookmark(batch, cursor_col, key_col).collect()[0]
    if found["batch_rows"]:
        last = found["last_cursor"]
        is_ts = isinstance(last, _dt.datetime)
        feed = Feed(key, [cursor_col] if cursor_col != key else None, not_negative)
        _land(batch, feed, table, rejected, {
            "cursor": last.isoformat(sep=" ") if is_ts else last, "cursor_kind": "ts" if is_ts else "value",
            "key": found["last_key"]})
    return int(found["batch_rows"])
