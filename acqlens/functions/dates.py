"""Calendar arithmetic on zone-less timestamps (TIMESTAMP_NTZ) and dates.

Everything here is independent of ``spark.sql.session.timeZone``.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def to_second(ts: Column | str) -> Column:
    """Truncate a TIMESTAMP_NTZ to whole seconds, staying NTZ (date_trunc would return a zoned type)."""
    t = _c(ts)
    return F.make_timestamp_ntz(F.year(t), F.month(t), F.dayofmonth(t), F.hour(t), F.minute(t), F.second(t))


def round_to_second(ts: Column | str) -> Column:
    """Round a TIMESTAMP_NTZ to the nearest whole second (half up), staying zone-less."""
    return to_second(_c(ts) + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(0.5).cast("decimal(8,6)")))


def ntz(literal: str) -> Column:
    """TIMESTAMP_NTZ literal from 'yyyy-MM-dd HH:mm:ss'."""
    return F.expr(f"TIMESTAMP_NTZ '{literal}'")


def day_diff(start: Column | str, end: Column | str) -> Column:
    """Calendar midnights crossed from ``start`` to ``end`` (dates or timestamps); NULL if either is NULL."""
    return F.datediff(F.to_date(_c(end)), F.to_date(_c(start)))


def plus_days(ts: Column | str, days: int | Column) -> Column:
    """Add whole days to a timestamp keeping the time of day."""
    d = F.lit(days) if isinstance(days, int) else days
    return _c(ts) + F.make_dt_interval(d.cast("int"), F.lit(0), F.lit(0), F.lit(0))


def plus_minutes(ts: Column | str, minutes: int | Column) -> Column:
    m = F.lit(minutes) if isinstance(minutes, int) else minutes
    return _c(ts) + F.make_dt_interval(F.lit(0), F.lit(0), m.cast("int"), F.lit(0))


def us_week_of_year(d: Column | str) -> Column:
    """Week number where week 1 holds 1 January and weeks start on Sunday (not ISO)."""
    day = _c(d)
    jan1_dow = F.dayofweek(F.trunc(day, "YEAR"))  # Sunday = 1
    return (F.floor((F.dayofyear(day) + jan1_dow - 2) / 7) + 1).cast("int")


def is_weekend(d: Column | str) -> Column:
    """1 for Sunday (1) and Saturday (7) under Sunday-first weekday numbering."""
    return F.when(F.dayofweek(_c(d)).isin(1, 7), 1).otherwise(0)
