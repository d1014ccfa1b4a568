"""Calendar and time-difference expressions.

All are Catalyst built-ins; nothing here runs Python per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def to_datetime(ts) -> Column:
    """toDateTime: second resolution, kept as TIMESTAMP_NTZ."""
    return F.date_trunc("second", _c(ts)).cast("timestamp_ntz")


def date_sk(ts) -> Column:
    """formatDateTime(d, '%Y%m%d') as an int key, e.g. 20240131."""
    return F.date_format(_c(ts), "yyyyMMdd").cast("int")


def yyyymm(d) -> Column:
    """toYYYYMM partition key."""
    return F.date_format(_c(d), "yyyyMM").cast("int")


def day_of_week_mon1(d) -> Column:
    """toDayOfWeek(d, 0): Monday=1 ... Sunday=7 (weekday() is Monday=0)."""
    return F.weekday(_c(d)) + 1


def week_of_year_sunday(d) -> Column:
    """toWeek(d) mode 0: weeks start on Sunday, days before the first Sunday
    of the year are week 0 (range 0-53). Not ISO weekofyear."""
    d = _c(d)
    return F.floor((F.dayofyear(d) + 6 - (F.dayofweek(d) - 1)) / 7).cast("int")


def seconds_between(a, b) -> Column:
    """dateDiff('second', a, b)."""
    return (F.unix_seconds(_c(b).cast("timestamp")) -
            F.unix_seconds(_c(a).cast("timestamp")))


def hours_crossed(a, b) -> Column:
    """dateDiff('hour', a, b): number of hour boundaries crossed between a and b
    (10:59 -> 11:01 is 1), which is not the elapsed-hours count."""
    ha = F.unix_seconds(F.date_trunc("hour", _c(a).cast("timestamp")))
    hb = F.unix_seconds(F.date_trunc("hour", _c(b).cast("timestamp")))
    return ((hb - ha) / 3600).cast("long")


def hour_start(ts) -> Column:
    """Start of the hour as TIMESTAMP_NTZ (snapshot_hour)."""
    return F.date_trunc("hour", _c(ts)).cast("timestamp_ntz")
