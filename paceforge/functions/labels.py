"""Labels, flags and scores derived from daily values, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paceforge.functions.units import ColumnLike, column, settled_round

# Thresholds (lowest value of each label) in descending order.
RECOVERY_BUCKETS = ((67, "peak"), (34, "optimal"))
SLEEP_LABELS = ((85, "excellent"), (70, "good"), (50, "fair"))
LOWEST_LABEL = "poor"
LOAD_SCALE = 100.0 / 21.0


def _graded(value: Column, steps: tuple[tuple[float, str], ...], lowest: str) -> Column:
    label = F.when(value.isNull(), F.lit(None).cast("string"))
    for least, name in steps:
        label = label.when(value >= least, name)
    return label.otherwise(lowest)


def recovery_bucket(score: ColumnLike) -> Column:
    """peak / optimal / poor; NULL stays NULL."""
    return _graded(column(score), RECOVERY_BUCKETS, LOWEST_LABEL)


def sleep_label(performance_pct: ColumnLike) -> Column:
    """excellent / good / fair / poor; NULL stays NULL."""
    return _graded(column(performance_pct), SLEEP_LABELS, LOWEST_LABEL)


def net_sleep_hours(in_bed: ColumnLike, awake: ColumnLike) -> Column:
    """Hours asleep; an unknown awake time counts as zero."""
    return settled_round(column(in_bed) - F.coalesce(column(awake), F.lit(0.0)), 2)


def high_intensity_min(*zones: ColumnLike) -> Column:
    """Minutes over the given zones, NULL as 0: the result is never NULL."""
    total = F.lit(0.0)
    for zone in zones:
        total = total + F.coalesce(column(zone), F.lit(0.0))
    return total


def recovery_delta(next_day: ColumnLike, same_day: ColumnLike) -> Column:
    return column(next_day) - column(same_day)


def daily_load(strain: ColumnLike) -> Column:
    """Strain on the 0-21 scale as a 0-100 load; no strain counts as rest."""
    return F.round(F.coalesce(column(strain), F.lit(0.0)) * F.lit(LOAD_SCALE), 2)


def form_label(ctl: ColumnLike, atl: ColumnLike) -> Column:
    """Form from fitness minus fatigue, both already rounded; an unknown balance is overtrained."""
    balance = column(ctl) - column(atl)
    return (
        F.when(balance > 25, "very_fresh")
        .when(balance > 5, "peak_form")
        .when(balance >= -10, "neutral")
        .when(balance >= -30, "fatigued")
        .otherwise("overtrained")
    )


def load_spike(ctl: ColumnLike, atl: ColumnLike) -> Column:
    """Fatigue above 1.5 times a non-zero fitness; NULL gives false."""
    spike = column(atl) > F.lit(1.5) * F.nullif(column(ctl), F.lit(0.0))
    return F.coalesce(spike, F.lit(False))


def is_running_sport(name: ColumnLike) -> Column:
    return F.lower(column(name)).like("%run%")
