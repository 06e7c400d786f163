"""Picks and shares over the runs of a calendar period."""

from __future__ import annotations

from collections.abc import Sequence

from datetime import date as Date
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceforge.operators.running import running_sum, sliced

# The range shown when no run has a speed.
NO_SPEEDS = (5.0, 10.0)
SMALLEST_SPAN = 0.1
#: Parts of a minute that are added up.
MINUTE_PARTS = 1_000_000
SORT_COLUMNS = {"time": "run_date", "dist": "distance_km", "speed": "speed_mph"}


def runs_in_period(runs: DataFrame, grain: str, key: str, date: str = "run_date") -> DataFrame:
    """Runs of a year, month, ISO week or day by its key, as a range of dates that a scan can use."""
    low, high = period_range(grain, key)
    return runs.where((F.col(date) >= F.lit(low)) & (F.col(date) < F.lit(high)))


def period_range(grain: str, key: str) -> tuple[Date, Date]:
    """First date of a period and of the next one."""
    if grain == "year":
        return Date(int(key), 1, 1), Date(int(key) + 1, 1, 1)
    if grain == "month":
        year, month = map(int, key.split("-"))
        return Date(year, month, 1), Date(year + month // 12, month % 12 + 1, 1)
    if grain == "week":
        year, week = key.split("-W")
        low = Date.fromisocalendar(int(year), int(week), 1)
        return low, low + timedelta(7)
    if grain == "day":
        low = Date.fromisoformat(key)
        return low, low + timedelta(1)
    raise ValueError(f"unknown period {grain}")


def sorted_runs(runs: DataFrame, by: str = "time", desc: bool = True, key: str = "run_id") -> DataFrame:
    """Runs by time, distance or speed; an unknown distance or speed counts as 0."""
    name = SORT_COLUMNS[by]
    sort = F.col(name) if by == "time" else F.coalesce(F.col(name), F.lit(0.0))
    return runs.orderBy(sort.desc() if desc else sort.asc(), key)


def newest(runs: DataFrame, n: int | None = None, date: str = "run_date", key: str = "run_id") -> DataFrame:
    """Runs by date, newest first, all of them or the first ``n``."""
    ordered = runs.orderBy(F.desc(date), F.desc(key))
    return ordered if n is None else ordered.limit(n)


def mapped_runs(runs: DataFrame, limit: int | None = None, line: str = "summary_polyline") -> DataFrame:
    """Runs that carry an encoded route, newest first."""
    return newest(runs.where(F.col(line).isNotNull() & (F.col(line) != "")), limit)


def highlights(runs: DataFrame, key: str = "run_id") -> DataFrame:
    """Longest, fastest and latest run among those with a route and a speed; ties to the lowest key.

    One aggregate finds all three, so every task sends on one candidate of each.
    """
    candidates = runs.where(
        F.col("summary_polyline").isNotNull()
        & (F.col("summary_polyline") != "")
        & F.col("speed_mph").isNotNull()
        & (F.col("speed_mph") != 0)
    )
    row = F.struct(key, "run_date", "distance_km", "speed_mph")
    # Sorted downwards by a negated value, so that the smallest key, of any type, wins a tie.
    best = candidates.agg(
        *[
            F.min_by(row, F.struct(sort.alias("sort"), F.col(key).alias("tie"))).alias(name)
            for name, sort in {
                "longest": -F.coalesce("distance_km", F.lit(0.0)),
                "fastest": -F.col("speed_mph"),
                "latest": F.coalesce(-F.unix_date("run_date"), F.lit(2**31 - 1)),
            }.items()
        ]
    )
    picks = F.array(
        *[
            F.struct(F.lit(name).alias("highlight"), F.col(name).alias("run"))
            for name in ("longest", "fastest", "latest")
        ]
    )
    return (
        best.select(F.explode(picks).alias("pick"))
        .where(F.col("pick.run").isNotNull())
        .select("pick.highlight", "pick.run.*")
    )


def speed_range(runs: DataFrame, speed: str = "speed_mph") -> DataFrame:
    """Lowest and highest speed of all runs that have one, as one row."""
    measured = runs.where(F.col(speed).isNotNull() & (F.col(speed) != 0))
    return measured.agg(
        F.coalesce(F.min(speed), F.lit(NO_SPEEDS[0])).alias("min_speed"),
        F.coalesce(F.max(speed), F.lit(NO_SPEEDS[1])).alias("max_speed"),
    )


def speed_scale(runs: DataFrame, speed: str = "speed_mph", out: str = "speed_position") -> DataFrame:
    """Add the place of each speed between the lowest and the highest, from 0 to 1."""
    limits = speed_range(runs, speed).select(F.struct("min_speed", "max_speed")).scalar()
    low, high = limits["min_speed"], limits["max_speed"]
    place = (F.col(speed) - low) / F.greatest(high - low, F.lit(SMALLEST_SPAN))
    clamped = F.greatest(F.lit(0.0), F.least(F.lit(1.0), place))
    return runs.withColumn(out, F.when(F.col(speed).isNotNull(), clamped))


def period_slots(
    runs: DataFrame,
    keys: Sequence[str],
    minutes: str = "moving_time_min",
    date: str = "run_date",
    key: str = "run_id",
    slices: int | None = None,
) -> DataFrame:
    """Add the share of the period's minutes that lies before and up to the end of each run.

    Runs follow one another by date, then by their key. Unknown or zero minutes count as one; minutes are
    added up in millionths. ``slices``: see ``running.sliced``.
    """
    known = F.coalesce(F.nullif(F.col(minutes), F.lit(0.0)), F.lit(1.0))
    parts = runs.withColumn("__parts", F.round(known * MINUTE_PARTS).cast("bigint"))
    order = [date, key]
    summed = running_sum(sliced(parts, keys, order, slices), keys, order, "__parts", "__start", "__end", "__total", "__is_last")
    return summed.select(
        *runs.columns,
        (F.col("__start") / F.col("__total")).alias("slot_start"),
        (F.col("__end") / F.col("__total")).alias("slot_end"),
    )
