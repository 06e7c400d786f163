"""Training load per day and per week."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paceforge.functions import labels
from paceforge.operators import rolling
from paceforge.operators.aggregates import weekly_load, weekly_runs
from paceforge.operators.load import ewma_load


_DAY = "__day"
LOAD_COLUMNS = (
    "cycle_date",
    "user_id",
    "daily_tss",
    "strain_score",
    "recovery_score",
    "hrv_rmssd_milli",
    "resting_heart_rate",
)


def int_training_load(daily: DataFrame, unique_days: bool = True) -> DataFrame:
    """Fitness, fatigue and form per user and day, on one shuffle by user.

    Two rows for one user and day make the later figures ambiguous, so by default they raise an
    error. With ``unique_days=False`` both rows stay and each counts the load of both; rows equal in
    every column become one that counts as often as it came, and its own sums with it.
    """
    loads = daily.where(F.col("cycle_date").isNotNull()).withColumn(
        "daily_tss", labels.daily_load("strain_score")
    )
    # All windows go by the number of the day, which the look-back needs, and so share one sort.
    loads = loads.select(*LOAD_COLUMNS, F.unix_date("cycle_date").alias(_DAY))
    if unique_days:
        window = rolling.by_day(day=_DAY)
        repeated = F.lag(_DAY).over(window) == F.col(_DAY)
        failure = F.raise_error(F.lit("two rows for one user and day; see check_unique"))
        day = F.when(repeated, failure.cast("date")).otherwise(F.col("cycle_date"))
        weighted = ewma_load(loads, "daily_tss", day=_DAY)
    else:
        rest = [c for c in LOAD_COLUMNS if c not in ("user_id", "cycle_date")]
        window = Window.partitionBy("user_id").orderBy(_DAY, *rest)
        day = F.col("cycle_date")
        counted = loads.groupBy(*LOAD_COLUMNS, _DAY).agg(F.count(F.lit(1)).alias("__times"))
        counted = counted.withColumn("__load", F.col("daily_tss") * F.col("__times"))
        weighted = ewma_load(counted, "__load", day=_DAY, digits=None)
        for name in ("ctl", "atl"):
            weighted = weighted.withColumn(name, F.round(F.col(name) * F.col("__times"), 1))
    return weighted.select(
        day.alias("cycle_date"),
        *LOAD_COLUMNS[1:],
        "ctl",
        "atl",
        F.round(F.col("ctl") - F.col("atl"), 1).alias("tsb"),
        labels.form_label("ctl", "atl").alias("form_label"),
        rolling.trend_label("ctl", window).alias("fitness_phase"),
        rolling.trend_delta("ctl", window).alias("ctl_7d_delta"),
        rolling.monotony("daily_tss", window).alias("training_monotony_7d"),
    )


def fct_weekly_training_summary(
    load: DataFrame, runs: DataFrame, user_col: str | None = None
) -> DataFrame:
    """Weekly load with the runs of the week and the change from the week before.

    Without ``user_col`` runs are summed per week over all users, which is one row per calendar
    week: that bound makes the broadcast safe. Weeks with runs but no load are left out.
    """
    by_week = weekly_runs(runs, user_col)
    if user_col is None:
        joined = weekly_load(load).join(F.broadcast(by_week), "week_start", "left")
    else:
        by_week = by_week.withColumnRenamed(user_col, "user_id")
        joined = weekly_load(load).join(by_week, ["week_start", "user_id"], "left")
    window = rolling.by_day("user_id", "week_start")
    return joined.select(
        "week_start",
        "week_end",
        "user_id",
        "tracked_days",
        "total_weekly_tss",
        "avg_daily_tss",
        "week_end_ctl",
        "week_end_atl",
        "week_end_tsb",
        "week_end_form",
        "fitness_phase",
        "avg_recovery",
        "avg_hrv_rmssd",
        "avg_rhr",
        "avg_monotony",
        "hard_days",
        "easy_or_rest_days",
        F.coalesce("run_count", F.lit(0)).alias("run_count"),
        "total_distance_km",
        "total_run_minutes",
        "avg_pace_min_per_km",
        "avg_run_hr",
        rolling.delta_prev("week_end_ctl", window, 1).alias("ctl_wow_delta"),
        rolling.delta_prev("total_weekly_tss", window, 1).alias("tss_wow_delta"),
        rolling.delta_prev("total_distance_km", window, 2, null_as_zero=True).alias(
            "distance_wow_delta_km"
        ),
        labels.load_spike("week_end_ctl", "week_end_atl").alias("load_spike_flag"),
    )
