"""Scheduled tasks as functions: one day, one month, backfill equals periods."""

import datetime as dt

from tabulark import catalog
from tabulark.plans import jobs
from tabulark.session import scratch_path

from conftest import SF0001


def test_publish_day_month_and_backfill(spark):
    dds = catalog.dds(spark, SF0001)
    days = scratch_path(spark, "job-days")
    one_by_one = scratch_path(spark, "job-days-single")
    first, last = dt.date(1999, 10, 1), dt.date(1999, 10, 10)
    jobs.backfill_days(dds, first, last, days)
    d = first
    while d <= last:
        jobs.publish_day(dds, d, one_by_one)
        d += dt.timedelta(days=1)
    a = sorted(map(tuple, spark.read.parquet(days).collect()))
    b = sorted(map(tuple, spark.read.parquet(one_by_one).collect()))
    assert a == b and len(a) > 0
    months = scratch_path(spark, "job-months")
    out = jobs.publish_month(dds, dt.date(2001, 7, 17), months)  # any day: truncated to July
    got = spark.read.parquet(months).collect()
    assert {(r.settlement_year, r.settlement_month) for r in got} == {(2001, 7)}
    assert len(got) == out.count()


def test_month_backfill_and_clear_if_empty(spark):
    from pyspark.sql import functions as F
    from tabulark.plans import marts
    dds = catalog.dds(spark, SF0001)
    whole = scratch_path(spark, "job-months-range")
    single = scratch_path(spark, "job-months-single")
    months = [dt.date(2001, 5, 1), dt.date(2001, 6, 1), dt.date(2001, 7, 1)]
    jobs.backfill_months(dds, months[0], months[-1], whole)
    for m in months:
        jobs.publish_month(dds, m, single)
    a = sorted(map(tuple, spark.read.parquet(whole).collect()))
    b = sorted(map(tuple, spark.read.parquet(single).collect()))
    assert a == b and {(r[2], r[3]) for r in spark.read.parquet(whole).select(
        "courier_id", "courier_name", "settlement_year", "settlement_month").collect()} == {
        (2001, 5), (2001, 6), (2001, 7)}
    # A rerun of May..July that now has rows for July only: literal keeps May and
    # June, clear_if_empty empties them.
    july = marts.courier_ledger(dds["fct_deliveries"], dds["dm_couriers"], first_month=months[2],
                                ordered=False)
    marts.publish_ledger(july, whole, months[0], months[-1])
    assert spark.read.parquet(whole).select("settlement_month").distinct().count() == 3
    marts.publish_ledger(july, whole, months[0], months[-1], clear_if_empty=True)
    left = spark.read.parquet(whole).select("settlement_month").distinct().collect()
    assert [r.settlement_month for r in left] == [7]
    assert spark.read.parquet(whole).filter(F.col("settlement_month") == 7).count() == july.count()


def test_load_dds_writes_tables_and_keeps_the_rest(spark):
    from tabulark.plans.dds import materialized_stg
    stg = materialized_stg(spark, SF0001).all()
    dds = jobs.load_dds(spark, stg)
    assert list(dds) == list(catalog.dds(spark, SF0001).names())
    for name in ("fct_product_sales", "dm_orders"):
        plan = dds[name]._jdf.queryExecution().toString()
        assert "from_json" not in plan and "order_month" in plan
    assert dds.pending["fct_product_sales"].isEmpty() and dds.rejected["dm_orders"].isEmpty()
    day = dt.date(1999, 10, 1)
    report = jobs.publish_day(dds, day, scratch_path(spark, "job-load"))
    want = catalog.queries()["settlement_report"](spark, SF0001).filter(f"settlement_date = DATE '{day}'")
    assert sorted(map(tuple, report.collect())) == sorted(map(tuple, want.collect()))


def test_an_interrupted_backfill_goes_on(spark, monkeypatch):
    from tabulark.sources.sinks import Table
    dds = catalog.dds(spark, SF0001)
    saved, path = Table(spark, scratch_path(spark, "job-saved")), scratch_path(spark, "job-resume")
    first, last = dt.date(1999, 10, 1), dt.date(1999, 10, 9)
    publish, calls = jobs.backfill_days, []

    def failing(d, a, b, p):
        if len(calls) == 1:
            raise RuntimeError("lost")
        calls.append(a)
        return publish(d, a, b, p)

    monkeypatch.setattr(jobs, "backfill_days", failing)
    try:
        jobs.resume_days(dds, first, last, path, saved, step=3)
    except RuntimeError:
        pass
    monkeypatch.setattr(jobs, "backfill_days", publish)
    assert jobs.last_published(saved, jobs.SETTLEMENT) == dt.date(1999, 10, 3)
    assert jobs.resume_days(dds, first, last, path, saved, step=3) == 2
    whole = scratch_path(spark, "job-resume-whole")
    jobs.backfill_days(dds, first, last, whole)
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == sorted(map(tuple, spark.read.parquet(whole).collect()))


def test_an_interrupted_ledger_backfill_goes_on(spark, monkeypatch):
    from tabulark.sources.sinks import Table
    dds = catalog.dds(spark, SF0001)
    saved, path = Table(spark, scratch_path(spark, "job-months-saved")), scratch_path(spark, "job-months-resume")
    first, last = dt.date(1999, 11, 20), dt.date(2000, 2, 3)  # any day: truncated to the month
    publish, calls = jobs.backfill_months, []

    def failing(d, a, b, p):
        if calls:
            raise RuntimeError("lost")
        calls.append(a)
        return publish(d, a, b, p)

    monkeypatch.setattr(jobs, "backfill_months", failing)
    try:
        jobs.resume_months(dds, first, last, path, saved, step=2)
    except RuntimeError:
        pass
    monkeypatch.setattr(jobs, "backfill_months", publish)
    assert jobs.last_published(saved, jobs.LEDGER) == dt.date(1999, 12, 1)
    assert jobs.resume_months(dds, first, last, path, saved, step=2) == 1
    assert jobs.resume_months(dds, first, last, path, saved, step=2) == 0
    whole = scratch_path(spark, "job-months-resume-whole")
    publish(dds, first, last, whole)
    assert sorted(map(str, spark.read.parquet(path).collect())) == sorted(map(str, spark.read.parquet(whole).collect()))
