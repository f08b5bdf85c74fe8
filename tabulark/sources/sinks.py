"""Sinks (S11-S17) over Parquet folders.

A table is a set of immutable Parquet folders and a pointer file that names
the live ones, with the load's bookmark beside them.  A write lands a fresh
folder and then publishes the next pointer: a complete temporary file renamed to
its numbered name, which must not exist.  The number follows the pointer that
was read when the write began, so of two writers that began on the same state
one fails and may retry; a crash leaves the state before; data and bookmark move
together.

* ``append``            one more folder;
* ``upsert``            one more folder with the batch's newest row per key;
                        readers take the newest row per key of all folders, by
                        the order columns and then by load, so an older row that
                        arrives later never wins; ``compact`` folds the folders;
* ``insert_ignore``     batch rows whose key is absent (left anti join);
* ``replace_periods``   dynamic partition overwrite of the periods present
                        in the batch; other periods untouched.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedupe import latest_per_key, newest_rows
from ..operators.ids import assign_dense_ids
from ..session import PACKED, dropping_scratch, stored

LOAD = "_load"  # number of the load that wrote a row
ARRIVED = "arrived"  # the same, as ``arrivals`` hands it to a reader
REASON = "_reason"  # why a landed row is rejected; null in all rows of a published folder


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _newest(folder: str) -> int | None:
    """Largest load number in a folder, as its name tells; None where it does not."""
    return int(folder.split("-")[1]) if folder.startswith("load-") else None


@dataclass(frozen=True)
class State:
    """What a pointer says; version 0 is the empty table."""
    version: int = 0
    folders: list[str] = field(default_factory=list)
    keys: list[str] | None = None        # of an upserted table
    order_by: list[str] | None = None
    bookmark: dict | None = None
    max_id: int = 0
    disjoint: bool = False               # no key stands in two folders


class Table:
    """A Parquet table published by pointer files ``<root>/_pointers/v*``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def state(self, version: int | None = None) -> State:
        """What the last pointer says, or that of a version."""
        if version == 0:
            return State()
        fs, p = _fs(self.spark, f"{self.root}/_pointers")
        names = [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []
        versions = [int(n[1:]) for n in names if n.startswith("v")]
        if not versions:
            return State()
        fs, p = _fs(self.spark, f"{self.root}/_pointers/v{version or max(versions):012d}")
        stream = fs.open(p)
        try:
            jvm = self.spark.sparkContext._jvm
            text = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine()
        finally:
            stream.close()
        return State(**json.loads(text))

    def publish(self, begun: State, **changes) -> State:
        """The state after ``begun``; fails if another writer has published it."""
        new = State(**{**begun.__dict__, "disjoint": False, **changes, "version": begun.version + 1})
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        fs, tmp = _fs(self.spark, f"{self.root}/_pointers/.{uuid.uuid4().hex}")
        out = fs.create(tmp, False)
        try:
            out.write(bytearray(json.dumps(new.__dict__), "utf-8"))
        finally:
            out.close()
        target = jvm.org.apache.hadoop.fs.Path(f"{self.root}/_pointers/v{new.version:012d}")
        qualified = fs.makeQualified(target)
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(qualified.toUri(), conf)
        options = self.spark.sparkContext._gateway.new_array(
            getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        context.rename(fs.makeQualified(tmp), qualified, options)
        return new

    def bookmark(self) -> dict | None:
        return self.state().bookmark

    def max_id(self) -> int:
        return self.state().max_id

    # -- reads -----------------------------------------------------------------
    def _rows(self, state: State) -> DataFrame | None:
        if not state.folders:
            return None
        return self._open(state.folders)

    def _open(self, folders: list[str]) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.root}/{f}" for f in folders]).drop(REASON)

    def read(self, state: State | None = None) -> DataFrame | None:
        """The current rows; None while nothing was written."""
        rows = self._current(state or self.state())
        return rows if rows is None else rows.drop(LOAD)

    def _current(self, state: State) -> DataFrame | None:
        rows = self._rows(state)
        if rows is not None and LOAD in rows.columns and len(state.folders) > 1 and state.keys and not state.disjoint:
            rows = latest_per_key(rows, state.keys, [*(state.order_by or []), LOAD])
        return rows

    def arrivals(self, after: int, state: State | None = None) -> DataFrame | None:
        """Rows of an upserted table that loads after number ``after`` brought, with
        the load's number as ``arrived``: the newest per key where several loads
        brought it.  Whatever time a row carries, it is found by the load that
        landed it.  Folders of earlier loads are not opened; None while nothing
        was written."""
        state = state or self.state()
        if not state.folders:
            return None
        late = [f for f in state.folders if (n := _newest(f)) is None or n > after]
        # Nothing new: the last folder, which the filter empties.
        rows = self._open(late or state.folders[-1:])
        rows = rows.filter(F.col(LOAD) > F.lit(after))
        if len(late) > 1:
            rows = latest_per_key(rows, state.keys, [*(state.order_by or []), LOAD])
        return rows.withColumnRenamed(LOAD, ARRIVED)

    def changes(self, after: int, state: State | None = None) -> DataFrame | None:
        """Rows that versions after ``after`` brought: of an upserted table by load,
        of any other table those of folders that ``after`` did not have (all of them,
        once they were folded).  None while nothing was written."""
        state = state or self.state()
        if not state.folders:
            return None
        if state.keys:
            return self.arrivals(after, state).drop(ARRIVED)
        held = set(self.state(after).folders)
        new = [f for f in state.folders if f not in held]
        return self._open(new) if new else self._rows(state).limit(0)

    # -- writes ----------------------------------------------------------------
    def _land(self, df: DataFrame, load: int | None = None) -> str:
        """A fresh folder of ``df``, whose rows are of loads up to number ``load``."""
        folder = f"{'data' if load is None else f'load-{load:012d}'}-{uuid.uuid4().hex[:16]}"
        df.write.options(**PACKED).parquet(f"{self.root}/{folder}")
        return folder

    def _numbered(self, folder: str, keys: list[str], id_col: str | None, begun: State) -> tuple[int, bool]:
        """Largest id with the folder, and whether its keys are all new: a row whose
        key the table held has an id from before (a null key meets none, so it may be held)."""
        if not id_col and begun.disjoint:
            return begun.max_id, not may_share(self._open([folder]), self._rows(begun), keys)
        if not id_col:
            return begun.max_id, not begun.folders
        old = F.col(id_col) <= F.lit(begun.max_id)
        for c in keys:
            old = old | F.col(c).isNull()
        top, held = self._open([folder]).agg(
            F.max(id_col), F.count_if(old)).collect()[0]
        return max(int(top or 0), begun.max_id), not begun.folders or (begun.disjoint and not held)

    def replace(self, df: DataFrame, bookmark: dict | None = None) -> State:
        begun = self.state()
        return self.publish(begun, folders=[self._land(df)], keys=None, order_by=None,
                            bookmark=bookmark or begun.bookmark)

    def add_first(self, df: DataFrame):
        """Append ``df``, and return a function that leaves it as the only content:
        one write for a set that is replaced in two steps."""
        begun = self.state()
        folder = self._land(df)
        added = self.publish(begun, folders=[*begun.folders, folder])
        return lambda: self.publish(added, folders=[folder], keys=None, order_by=None)

    def append(self, df: DataFrame, bookmark: dict | None = None) -> State:
        begun = self.state()
        return self.publish(begun, folders=[*begun.folders, self._land(df)],
                            bookmark=bookmark or begun.bookmark)

    def upsert(self, batch: DataFrame, keys: list[str], order_by: list[str] | None = None,
               id_col: str | None = None, bookmark: dict | None = None, unique: bool = False) -> State:
        """Write the batch's newest row per key; the table is read for its keys
        and ids alone, and never rewritten.  ``unique``: the batch has one row per key."""
        begun = self.state()
        rows = batch
        if not unique:
            rows = latest_per_key(batch, keys, order_by) if order_by else batch.dropDuplicates(keys)
        with dropping_scratch(self.spark):
            if id_col:
                rows = with_ids(rows, self._rows(begun), keys, id_col, begun.max_id)
            folder = self.land_load(rows, begun)
        return self.publish_load(folder, begun, keys, order_by, id_col, bookmark)

    def land_load(self, rows: DataFrame, begun: State) -> str:
        """A folder of ``rows`` as the load after ``begun``, not published yet."""
        load = begun.version + 1
        return self._land(rows.withColumn(LOAD, F.lit(load)), load)

    def publish_load(self, folder: str, begun: State, keys: list[str], order_by: list[str] | None = None,
                     id_col: str | None = None, bookmark: dict | None = None) -> State:
        """Publish a folder of ``land_load`` that holds one row per key, none rejected."""
        with dropping_scratch(self.spark):
            top, disjoint = self._numbered(folder, keys, id_col, begun)
        return self.publish(begun, folders=[*begun.folders, folder], keys=keys, order_by=order_by,
                            max_id=top, disjoint=disjoint and begun.keys in (None, keys),
                            bookmark=bookmark or begun.bookmark)

    def insert_ignore(self, batch: DataFrame, keys: list[str], bookmark: dict | None = None,
                      unique: bool = False) -> State:
        """Add the batch's rows whose key is absent.  ``unique``: the batch has one row per
        key.  The batch is evaluated more than once and must give the same rows each time."""
        begun = self.state()
        with dropping_scratch(self.spark):
            rows = merge_insert_ignore(self._rows(begun), batch, keys, unique)
            folder = self._land(rows)
        return self.publish(begun, folders=[*begun.folders, folder], bookmark=bookmark or begun.bookmark)

    def compact(self) -> State:
        """One folder in place of several; rows, their load numbers, bookmark and
        largest id stay.  Old folders stay for readers of earlier pointers."""
        begun = self.state()
        if len(begun.folders) < 2:
            return begun
        rows = self._current(begun)
        return self.publish(begun, folders=[self._land(rows, begun.version if begun.keys else None)],
                            disjoint=bool(begun.keys))


# --- set-based merge operators (pure DataFrame -> DataFrame) ----------------------

def may_share(rows: DataFrame, held: DataFrame, keys: list[str]) -> bool:
    """Whether a key may stand in both, told by hashes of the keys alone, 8 bytes a row
    (a shared hash may be a shared key); False is certain."""
    if any(rows.schema[c].dataType != held.schema[c].dataType for c in keys):
        return True  # equal values of two types have two hashes
    name = F.xxhash64(*keys).alias("_h")
    return not rows.select(name).join(held.select(name), "_h", "left_semi").isEmpty()


def with_ids(rows: DataFrame, held: DataFrame | None, keys: list[str], id_col: str,
             start: int) -> DataFrame:
    """``rows`` with the ids that ``held`` gives their keys, and dense ids after
    ``start``, in key order, for new keys."""
    if held is None or not may_share(rows, held, keys):
        return assign_dense_ids(rows, keys, id_col=id_col, start=start)
    known = held.groupBy(*keys).agg(F.min(id_col).alias(id_col))
    joined = stored(rows.join(known, keys, "left").select(id_col, *rows.columns), "known-ids")
    fresh = assign_dense_ids(joined.filter(F.col(id_col).isNull()).drop(id_col), keys,
                             id_col=id_col, start=start)
    return joined.filter(F.col(id_col).isNotNull()).unionByName(fresh)


def merge_upsert(target: DataFrame | None, batch: DataFrame, keys: list[str],
                 order_by: list[str] | None = None, id_col: str | None = None,
                 id_start: int | None = None) -> DataFrame:
    """New table state: per key the newest row of target and batch by
    ``order_by``, the batch's row where they are equal (or without order)."""
    b = latest_per_key(batch, keys, order_by) if order_by else batch.dropDuplicates(keys)
    if id_col:
        start = id_start if id_start is not None else (
            0 if target is None else int(target.agg(F.max(id_col)).collect()[0][0] or 0))
        b = with_ids(b, target, keys, id_col, start)
    if target is None:
        return b
    both = target.withColumn(LOAD, F.lit(0)).unionByName(b.withColumn(LOAD, F.lit(1)))
    return latest_per_key(both, keys, [*(order_by or []), LOAD]).drop(LOAD)


def merge_insert_ignore(target: DataFrame | None, batch: DataFrame, keys: list[str],
                        unique: bool = False) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``target`` (ON CONFLICT DO NOTHING).  Whole rows
    are shuffled only where keys repeat or may stand in both."""
    b = batch if unique else newest_rows(batch, keys, None)
    if target is None or not may_share(b, target, keys):
        return b
    return b.join(target.select(*keys), keys, "left_anti")


# --- table-level sinks -------------------------------------------------------------

def sink_append(table: Table, batch: DataFrame, bookmark: dict | None = None) -> DataFrame:
    return table.read(table.append(batch, bookmark))


def sink_upsert(table: Table, batch: DataFrame, keys: list[str],
                order_by: list[str] | None = None, id_col: str | None = None,
                bookmark: dict | None = None) -> DataFrame:
    return table.read(table.upsert(batch, keys, order_by, id_col, bookmark))


def sink_insert_ignore(table: Table, batch: DataFrame, keys: list[str],
                       bookmark: dict | None = None) -> DataFrame:
    return table.read(table.insert_ignore(batch, keys, bookmark))


def replace_periods(df: DataFrame, path: str, period_cols: list[str],
                    clear_periods: list[dict] | None = None) -> None:
    """Write ``df`` partitioned by ``period_cols``; only the periods present in
    ``df`` are replaced (dynamic partition overwrite, as a write option, so the
    caller's session stays as it is).  ``clear_periods`` names periods to empty
    even when ``df`` has no rows for them (the ``clear_if_empty`` form; the
    default keeps stale rows, as the source system does)."""
    spark = df.sparkSession
    # Rebalanced by period: no sampling pass over the mart, small periods share a
    # writer, and a period with very many rows is split among several.
    (df.hint("rebalance", *[F.col(c) for c in period_cols]).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*period_cols).parquet(path))
    if clear_periods:
        # Periods asked for that the batch does not contain: one small
        # aggregate gives the periods present (bounded by the range asked).
        present = {tuple(str(v) for v in r) for r in df.select(*period_cols).distinct().collect()}
        for period in clear_periods:
            if tuple(str(period[c]) for c in period_cols) in present:
                continue
            sub = "/".join(f"{c}={period[c]}" for c in period_cols)
            fs, p = _fs(spark, f"{path}/{sub}")
            if fs.exists(p):
                fs.delete(p, True)
