"""Windows over the daily rows of one user.

Frames count rows, not days: a day without data widens the window. Input is at the grain of user
and day (``check_unique``), so one partition holds at most the days of one life, however many
records each day was made from. All functions share one window order, which Spark computes with one
shuffle and one sort.
"""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

from paceforge.functions.units import ColumnLike, column, settled_round


def by_day(user: str = "user_id", day: str = "cycle_date", *ties: str) -> WindowSpec:
    """Days of a user in order; ``ties`` put the rows of one day in order where it can have more than one."""
    return Window.partitionBy(user).orderBy(day, *ties)


def rolling_avg(c: ColumnLike, window: WindowSpec, rows: int, digits: int) -> Column:
    """Average over the last ``rows`` rows, the current one among them."""
    frame = window.rowsBetween(1 - rows, Window.currentRow)
    return settled_round(F.avg(column(c)).over(frame), digits)


def delta_prev(c: ColumnLike, window: WindowSpec, digits: int | None = None, null_as_zero: bool = False) -> Column:
    """Difference to the previous row; with ``null_as_zero`` a missing side counts as 0."""
    now, before = column(c), F.lag(column(c)).over(window)
    if null_as_zero:
        now, before = F.coalesce(now, F.lit(0.0)), F.coalesce(before, F.lit(0.0))
    delta = now - before
    return delta if digits is None else F.round(delta, digits)


def trend_label(c: ColumnLike, window: WindowSpec, lag: int = 7) -> Column:
    """building / declining against ``lag`` rows ago; equal or no such row is maintaining."""
    now, before = column(c), F.lag(column(c), lag).over(window)
    return F.when(now > before, "building").when(now < before, "declining").otherwise("maintaining")


def trend_delta(c: ColumnLike, window: WindowSpec, lag: int = 7, digits: int = 1) -> Column:
    return F.round(column(c) - F.lag(column(c), lag).over(window), digits)


def monotony(c: ColumnLike, window: WindowSpec, rows: int = 7, digits: int = 2) -> Column:
    """Mean over sample deviation of the last rows; NULL for one row or for equal values."""
    frame = window.rowsBetween(1 - rows, Window.currentRow)
    deviation = F.nullif(F.stddev_samp(column(c)).over(frame), F.lit(0.0))
    return F.round(F.avg(column(c)).over(frame) / deviation, digits)
