"""Unit conversions and date helpers, as column expressions.

Divisors are Python floats, so that they reach Spark as DOUBLE (a literal such as ``3600000.0`` in
SQL text would be a DECIMAL), and division by zero gives NULL instead of an ANSI error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str

# Fixed values.
MS_PER_HOUR = 3600000.0
MS_PER_MINUTE = 60000.0
KMH_PER_MS = 3.6
MPH_PER_KMH = 0.621371


def column(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(numerator: ColumnLike, denominator: ColumnLike | float) -> Column:
    """Double division; NULL when the denominator is zero or NULL."""
    below = F.lit(float(denominator)) if isinstance(denominator, (int, float)) else column(denominator)
    return F.try_divide(column(numerator).cast("double"), below.cast("double"))


def settled_round(c: Column, digits: int) -> Column:
    """Round the result of a sum, average or difference of doubles.

    The last bits of such a result depend on the order of the terms, and on a tie they would decide
    the rounding. Rounding to nine digits first takes them off, so every run gives the same.
    """
    return F.round(F.round(c, 9), digits)


def ms_to_hours(c: ColumnLike) -> Column:
    return ratio(c, MS_PER_HOUR)


def ms_to_minutes(c: ColumnLike) -> Column:
    return ratio(c, MS_PER_MINUTE)


def percent_to_fraction(c: ColumnLike) -> Column:
    return ratio(c, 100.0)


def metres_to_km(c: ColumnLike) -> Column:
    return ratio(c, 1000.0)


def seconds_to_minutes(c: ColumnLike) -> Column:
    return ratio(c, 60.0)


def pace_min_per_km(moving_time_sec: ColumnLike, distance_meter: ColumnLike) -> Column:
    """Minutes per kilometre; NULL for a zero distance."""
    return ratio(seconds_to_minutes(moving_time_sec), metres_to_km(distance_meter))


def speed_kmh(speed_ms: ColumnLike) -> Column:
    return F.round(column(speed_ms) * F.lit(KMH_PER_MS), 2)


def speed_mph(kmh: ColumnLike) -> Column:
    """Miles per hour; a zero speed counts as not measured and gives NULL."""
    return F.round(F.nullif(column(kmh), F.lit(0.0)) * F.lit(MPH_PER_KMH), 2)


def utc_date(ts: ColumnLike) -> Column:
    return F.to_date(column(ts))


def week_start(d: ColumnLike) -> Column:
    """Monday of the week, as a DATE."""
    return F.trunc(column(d), "week")


def period_key(d: ColumnLike, grain: str) -> Column:
    """Key of the calendar period: ``YYYY``, ``YYYY-MM``, ISO ``YYYY-Www`` or ``YYYY-MM-DD``."""
    day = column(d)
    if grain == "year":
        return F.date_format(day, "yyyy")
    if grain == "month":
        return F.date_format(day, "yyyy-MM")
    if grain == "week":
        year = F.extract(F.lit("YEAROFWEEK"), day).cast("string")
        week = F.lpad(F.weekofyear(day).cast("string"), 2, "0")
        return F.concat(F.lpad(year, 4, "0"), F.lit("-W"), week)
    if grain == "day":
        return F.date_format(day, "yyyy-MM-dd")
    raise ValueError(f"unknown period grain: {grain}")


PERIOD_GRAINS = ("year", "month", "week", "day")
