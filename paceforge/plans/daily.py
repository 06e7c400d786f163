"""Daily metrics: each cycle with its recovery and its main sleep."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceforge.functions import labels
from paceforge.operators.joins import attach_one
from paceforge.operators.versions import longest_sleep


def primary_sleeps(sleeps: DataFrame) -> DataFrame:
    """Sleeps that are known not to be naps; an unknown flag is dropped too."""
    return sleeps.where(~F.col("is_nap"))


def int_daily_metrics(cycles: DataFrame, recoveries: DataFrame, sleeps: DataFrame) -> DataFrame:
    """One row per cycle. All three inputs are hashed by cycle already, so the joins need no shuffle
    beyond those of the deduplication."""
    cycle = cycles.select(
        "cycle_id",
        "user_id",
        "cycle_date",
        "cycle_start",
        "cycle_end",
        F.col("score_state").alias("cycle_score_state"),
        "strain_score",
        F.col("kilojoule").alias("cycle_kilojoule"),
        F.col("avg_heart_rate").alias("cycle_avg_heart_rate"),
        F.col("max_heart_rate").alias("cycle_max_heart_rate"),
        "loaded_at",
    )
    recovery = recoveries.select(
        "cycle_id",
        "recovery_score",
        "resting_heart_rate",
        "hrv_rmssd_milli",
        "spo2_pct",
        "skin_temp_celsius",
        "is_calibrating",
        F.col("score_state").alias("recovery_score_state"),
    )
    sleep = longest_sleep(primary_sleeps(sleeps).where(F.col("cycle_id").isNotNull())).select(
        "cycle_id",
        "sleep_id",
        "sleep_start",
        "sleep_end",
        "in_bed_hours",
        "awake_hours",
        "light_sleep_hours",
        "sws_hours",
        "rem_hours",
        "sleep_cycle_count",
        "disturbance_count",
        "sleep_needed_baseline_hours",
        "respiratory_rate",
        "sleep_performance_pct",
        "sleep_consistency_pct",
        "sleep_efficiency_pct",
        F.col("score_state").alias("sleep_score_state"),
    )
    joined = attach_one(attach_one(cycle, recovery, "cycle_id"), sleep, "cycle_id")
    return joined.select(
        *[c for c in joined.columns if c != "loaded_at"],
        labels.net_sleep_hours("in_bed_hours", "awake_hours").alias("total_sleep_hours"),
        labels.recovery_bucket("recovery_score").alias("recovery_bucket"),
        labels.sleep_label("sleep_performance_pct").alias("sleep_quality_label"),
        "loaded_at",
    )
