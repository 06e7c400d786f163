"""Grouped aggregates. All of them pre-aggregate in each task before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paceforge.functions.units import period_key, settled_round, week_start


def rounded_avg(name: str, digits: int) -> Column:
    return settled_round(F.avg(name), digits)


def rounded_sum(name: str, digits: int) -> Column:
    return settled_round(F.sum(name), digits)


def lifetime_stats(daily: DataFrame, user: str = "user_id") -> DataFrame:
    """Lifetime aggregates of every user over the days that have a recovery score."""
    scored = daily.where(F.col("recovery_score").isNotNull() & F.col("cycle_date").isNotNull())
    return scored.groupBy(user).agg(
        F.countDistinct("cycle_date").alias("total_tracked_days"),
        F.min("cycle_date").alias("first_tracked_date"),
        F.max("cycle_date").alias("latest_tracked_date"),
        rounded_avg("recovery_score", 1).alias("avg_recovery_score"),
        F.round(F.max("recovery_score"), 1).alias("peak_recovery_score"),
        rounded_avg("strain_score", 1).alias("avg_strain_score"),
        F.round(F.max("strain_score"), 1).alias("peak_strain_score"),
        rounded_avg("sleep_performance_pct", 1).alias("avg_sleep_performance_pct"),
        rounded_avg("total_sleep_hours", 2).alias("avg_sleep_hours"),
        rounded_avg("hrv_rmssd_milli", 1).alias("avg_hrv_rmssd_milli"),
        F.round(F.max("hrv_rmssd_milli"), 1).alias("peak_hrv_rmssd_milli"),
    )


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def weekly_figures(order: str | Column = "cycle_date") -> list[Column]:
    """Sums, snapshot at the last row by ``order``, and wellness averages of a user's week."""
    return [
        F.count(F.lit(1)).alias("tracked_days"),
        rounded_sum("daily_tss", 1).alias("total_weekly_tss"),
        rounded_avg("daily_tss", 1).alias("avg_daily_tss"),
        F.round(F.max_by("ctl", order), 1).alias("week_end_ctl"),
        F.round(F.max_by("atl", order), 1).alias("week_end_atl"),
        F.round(F.max_by("tsb", order), 1).alias("week_end_tsb"),
        F.max_by("form_label", order).alias("week_end_form"),
        F.max_by("fitness_phase", order).alias("fitness_phase"),
        rounded_avg("recovery_score", 1).alias("avg_recovery"),
        rounded_avg("hrv_rmssd_milli", 1).alias("avg_hrv_rmssd"),
        rounded_avg("resting_heart_rate", 1).alias("avg_rhr"),
        rounded_avg("training_monotony_7d", 2).alias("avg_monotony"),
        count_where(F.col("strain_score") >= 10).alias("hard_days"),
        count_where((F.col("strain_score") < 5) | F.col("strain_score").isNull()).alias("easy_or_rest_days"),
    ]


def weekly_load(load: DataFrame, user: str = "user_id") -> DataFrame:
    """Load, snapshot of the last day and wellness averages, per user and Monday week."""
    weeks = load.withColumn("week_start", week_start("cycle_date")).groupBy("week_start", user).agg(*weekly_figures())
    return weeks.withColumn("week_end", F.date_add("week_start", 6))


def weekly_runs(runs: DataFrame, user_col: str | None = None) -> DataFrame:
    """Runs per Monday week, and per user where the runs carry one."""
    users = [user_col] if user_col else []
    dated = runs.where(F.col("run_date").isNotNull())
    return (
        dated.withColumn("week_start", week_start("run_date"))
        .groupBy("week_start", *users)
        .agg(
            F.count(F.lit(1)).alias("run_count"),
            rounded_sum("distance_km", 2).alias("total_distance_km"),
            rounded_sum("moving_time_min", 1).alias("total_run_minutes"),
            rounded_avg("pace_min_per_km", 2).alias("avg_pace_min_per_km"),
            rounded_avg("run_avg_hr", 1).alias("avg_run_hr"),
        )
    )


def period_counts(runs: DataFrame, grain: str, date: str = "run_date") -> DataFrame:
    """Runs per calendar period, newest period first."""
    dated = runs.where(F.col(date).isNotNull())
    counts = dated.groupBy(period_key(date, grain).alias("period")).agg(
        F.count(F.lit(1)).alias("run_count")
    )
    return counts.orderBy(F.desc("period"))
