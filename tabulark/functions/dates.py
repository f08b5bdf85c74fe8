"""Date and time functions (calendar parts, truncation, text formats).

All are built-in Spark expressions, so they stay inside whole-stage codegen.
Timestamps are zone-less (``timestamp_ntz``); ``date_trunc`` returns a
session-zone timestamp, so it is cast back.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text formats of the source system.
DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"
TIME_FORMAT = "HH:mm:ss"
# Fixed value: end of an open version.
OPEN_END = _dt.datetime(2099, 12, 31)


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trunc_ts(unit: str, c: str | Column) -> Column:
    """``date_trunc(unit, c)`` kept as ``timestamp_ntz``."""
    return F.date_trunc(unit, col_(c)).cast("timestamp_ntz")


def parse_ts(c: str | Column, fmt: str = DATETIME_FORMAT) -> Column:
    """Parse source text; bad text gives null instead of failing the batch."""
    return F.try_to_timestamp(col_(c), F.lit(fmt)).cast("timestamp_ntz")


def format_ts(c: str | Column, fmt: str = DATETIME_FORMAT) -> Column:
    return F.date_format(col_(c), fmt)


def calendar_parts(c: str | Column) -> dict[str, Column]:
    """Year, month, day, date text and time text of a timestamp."""
    ts = col_(c)
    return {
        "ts_year": F.year(ts),
        "ts_month": F.month(ts),
        "ts_day": F.dayofmonth(ts),
        "ts_date": F.date_format(ts, DATE_FORMAT),
        "ts_time": F.date_format(ts, TIME_FORMAT),
    }


def ts_lit(value) -> Column:
    """Zone-less timestamp literal (built from text, so no zone is applied)."""
    if isinstance(value, _dt.datetime):
        text = value.isoformat(sep=" ")
    elif isinstance(value, _dt.date):
        text = value.isoformat() + " 00:00:00"
    else:
        text = str(value)
    return F.lit(text).cast("timestamp_ntz")


def as_date(value) -> _dt.date:
    if isinstance(value, _dt.datetime):
        return value.date()
    if isinstance(value, _dt.date):
        return value
    return _dt.date.fromisoformat(str(value)[:10])


def month_start(value) -> _dt.date:
    d = as_date(value)
    return d.replace(day=1)


def add_months(d: _dt.date, n: int) -> _dt.date:
    y, m = divmod(d.month - 1 + n, 12)
    return _dt.date(d.year + y, m + 1, 1)


def day_range(c: str | Column, first, last) -> Column:
    """Half-open day range on a timestamp, written so Parquet can prune:
    ``first <= c < last + 1 day``."""
    lo = _dt.datetime.combine(as_date(first), _dt.time())
    hi = _dt.datetime.combine(as_date(last) + _dt.timedelta(days=1), _dt.time())
    return (col_(c) >= ts_lit(lo)) & (col_(c) < ts_lit(hi))


def month_range(c: str | Column, first, last=None) -> Column:
    """Months ``first..last`` as a half-open timestamp range (P4 rewritten
    from ``date_trunc('month', c) = m`` so the predicate reaches the scan)."""
    lo_d = month_start(first)
    hi_d = add_months(month_start(last if last is not None else first), 1)
    lo = _dt.datetime.combine(lo_d, _dt.time())
    hi = _dt.datetime.combine(hi_d, _dt.time())
    return (col_(c) >= ts_lit(lo)) & (col_(c) < ts_lit(hi))
