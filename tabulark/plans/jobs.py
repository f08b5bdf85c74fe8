"""The warehouse's scheduled tasks as plain functions.

What the source project runs as scheduled tasks, a user calls here:

* ``load_dds(spark, stg)``: the detail layer in build order (B12);
* ``publish_day(...)`` / ``publish_month(...)``: one settlement day or one
  ledger month, replacing only that period (S16, S17, Q19);
* ``backfill_days(...)`` / ``backfill_months(...)``: a whole range in one job
  (B11), not one job per period.

A scheduler (cron, an orchestrator) only has to call these; each is an
ordinary Spark job that reads its inputs from tables and writes its output
by dynamic partition overwrite.
"""

from __future__ import annotations

import json
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import add_months, as_date, month_start
from ..sources.bookmarks import read_setting
from ..sources.sinks import Table
from . import marts
from .dds import build_dds

# Workflow keys under which published periods are saved.
SETTLEMENT, LEDGER = "cdm_settlement_report", "cdm_courier_ledger"


class Loaded(dict):
    """dds tables by name; ``pending`` and ``rejected`` hold the rows each
    table could not take (by name, None where a table has none)."""

    def __init__(self, built: dict):
        super().__init__({name: b.table for name, b in built.items()})
        self.pending = {name: b.pending for name, b in built.items()}
        self.rejected = {name: b.rejected for name, b in built.items()}


def load_dds(spark: SparkSession, stg: dict[str, DataFrame]) -> Loaded:
    """dds tables from stg feeds (``orders restaurants users events couriers
    deliveries``), written in the source project's build order."""
    return Loaded(build_dds(spark, stg))


def _settlement_args(dds: dict[str, DataFrame]):
    return (dds["fct_product_sales"], dds["dm_orders"], dds["dm_restaurants"], dds["dm_timestamps"])


def publish_day(dds: dict[str, DataFrame], day, path: str, clear_if_empty: bool = False,
                saved: Table | None = None) -> DataFrame:
    """Settlement report of one day, written over that day's partition.

    ``saved`` is the bookmark table; the day is saved after it was published."""
    report = marts.settlement_report(*_settlement_args(dds), first_day=day, ordered=False)
    marts.publish_settlement(report, path, day, day, clear_if_empty)
    _save(saved, SETTLEMENT, as_date(day))
    return report


def _save(saved: Table | None, workflow: str, period) -> None:
    if saved is not None:
        row = saved.spark.createDataFrame([(workflow, json.dumps({"last_period": period.isoformat()}))],
                                          "workflow_key string, workflow_settings string")
        saved.upsert(row, ["workflow_key"])


def last_published(saved: Table, workflow: str):
    """The last period saved for a workflow; None before the first."""
    rows = saved.read()
    if rows is None:
        return None
    got = read_setting(rows.filter(F.col("workflow_key") == workflow), "last_period").collect()
    return as_date(got[0]["value"]) if got else None


def resume_days(dds: dict[str, DataFrame], first_day, last_day, path: str, saved: Table,
                step: int = 31) -> int:
    """Publish the days after the last one saved, ``step`` days a job, saving the
    bookmark after each, so an interrupted backfill goes on where it stopped.
    Returns the number of jobs run."""
    done, jobs = last_published(saved, SETTLEMENT), 0
    day, end = as_date(first_day), as_date(last_day)
    if done is not None:
        day = max(day, done + timedelta(days=1))
    while day <= end:
        upto = min(end, day + timedelta(days=step - 1))
        backfill_days(dds, day, upto, path)
        _save(saved, SETTLEMENT, upto)
        day, jobs = upto + timedelta(days=1), jobs + 1
    return jobs


def resume_months(dds: dict[str, DataFrame], first_month, last_month, path: str, saved: Table,
                  step: int = 12) -> int:
    """Publish the ledger's months after the last one saved, ``step`` months a job, as
    ``resume_days`` does for days.  Returns the number of jobs run."""
    done, jobs = last_published(saved, LEDGER), 0
    month, end = month_start(first_month), month_start(last_month)
    if done is not None:
        month = max(month, add_months(month_start(done), 1))
    while month <= end:
        upto = min(end, add_months(month, step - 1))
        backfill_months(dds, month, upto, path)
        _save(saved, LEDGER, upto)
        month, jobs = add_months(upto, 1), jobs + 1
    return jobs


def backfill_days(dds: dict[str, DataFrame], first_day, last_day, path: str,
                  clear_if_empty: bool = False) -> DataFrame:
    report = marts.settlement_report(*_settlement_args(dds), first_day=first_day,
                                     last_day=last_day, ordered=False)
    marts.publish_settlement(report, path, first_day, last_day, clear_if_empty)
    return report


def publish_month(dds: dict[str, DataFrame], any_day_of_month, path: str,
                  clear_if_empty: bool = False, saved: Table | None = None) -> DataFrame:
    """Courier ledger of the month containing ``any_day_of_month`` (the
    argument is truncated to the month, Q19)."""
    m = month_start(any_day_of_month)
    ledger = marts.courier_ledger(dds["fct_deliveries"], dds["dm_couriers"], first_month=m,
                                  ordered=False)
    marts.publish_ledger(ledger, path, m, m, clear_if_empty)
    _save(saved, LEDGER, m)
    return ledger


def backfill_months(dds: dict[str, DataFrame], first_month, last_month, path: str,
                    clear_if_empty: bool = False) -> DataFrame:
    ledger = marts.courier_ledger(dds["fct_deliveries"], dds["dm_couriers"],
                                  first_month=first_month, last_month=last_month, ordered=False)
    marts.publish_ledger(ledger, path, first_month, last_month, clear_if_empty)
    return ledger
