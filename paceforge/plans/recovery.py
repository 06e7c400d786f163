"""Activities with the recovery around them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceforge.functions import labels
from paceforge.operators.joins import attach_day, attach_days
from paceforge.operators.nearest import nearest_match

# Daily columns and their names next to an activity.
SAME_DAY = {
    "cycle_id": "same_day_cycle_id",
    "strain_score": "same_day_strain",
    "cycle_avg_heart_rate": "same_day_avg_hr",
    "recovery_score": "same_day_recovery",
    "recovery_bucket": "same_day_recovery_bucket",
    "hrv_rmssd_milli": "same_day_hrv",
    "sleep_performance_pct": "same_day_sleep_performance",
    "total_sleep_hours": "same_day_sleep_hours",
    "sleep_quality_label": "same_day_sleep_quality",
}
NEXT_DAY = {
    "cycle_id": "next_day_cycle_id",
    "recovery_score": "next_day_recovery",
    "recovery_bucket": "next_day_recovery_bucket",
    "hrv_rmssd_milli": "next_day_hrv",
    "resting_heart_rate": "next_day_resting_hr",
    "sleep_performance_pct": "next_day_sleep_performance",
    "total_sleep_hours": "next_day_sleep_hours",
    "sleep_quality_label": "next_day_sleep_quality",
}


def int_run_recovery(
    runs: DataFrame,
    daily: DataFrame,
    workouts: DataFrame,
    user_col: str | None = None,
    match_prefix: str = "matched_",
) -> DataFrame:
    """Each run with its own day, the day after, and the device workout nearest to its start.

    Runs carry no user of their own. Without ``user_col`` all joins are on the date alone, for the
    data of one user, and a date with the days of more users is an error. ``match_prefix`` starts the names of the columns of the matched workout.
    """
    users = [user_col] if user_col else []
    run = runs.select(
        "run_id",
        "run_name",
        "sport_type",
        "run_start",
        "run_date",
        "distance_km",
        "moving_time_min",
        "pace_min_per_km",
        "avg_speed_kmh",
        "total_elevation_gain_meter",
        F.col("average_heartrate").alias("run_avg_hr"),
        F.col("max_heartrate").alias("run_max_hr"),
        "average_cadence",
        "suffer_score",
        "summary_polyline",
        "primary_photo_url",
        "loaded_at",
        *users,
    )
    workout = {
        "workout_id": f"{match_prefix}workout_id",
        "sport_name": f"{match_prefix}sport_name",
        "strain_score": f"{match_prefix}workout_strain",
        "avg_heart_rate": f"{match_prefix}workout_avg_hr",
        "max_heart_rate": f"{match_prefix}workout_max_hr",
        "distance_meter": f"{match_prefix}workout_distance_meter",
        "high_intensity_min": f"{match_prefix}high_intensity_min",
    }
    intense = workouts.withColumnRenamed("workout_date", "run_date").withColumn(
        "high_intensity_min", labels.high_intensity_min("zone_3_min", "zone_4_min", "zone_5_min")
    )
    matched = nearest_match(
        run,
        intense,
        on=["run_date", *users],
        left_ts="run_start",
        right_ts="workout_start",
        right_key="workout_id",
        columns=workout,
        pred=labels.is_running_sport("sport_name"),
    )
    with_days = attach_days(matched, daily, {0: SAME_DAY, 1: NEXT_DAY}, "run_date", user_col=user_col)
    minutes = f"{match_prefix}high_intensity_min"
    return with_days.select(
        *[c for c in run.columns if c not in ("loaded_at", *users)],
        *SAME_DAY.values(),
        *NEXT_DAY.values(),
        labels.recovery_delta("next_day_recovery", "same_day_recovery").alias("recovery_delta"),
        *[c for c in workout.values() if c != minutes],
        F.coalesce(F.col(minutes), F.lit(0.0)).alias(minutes),
        "loaded_at",
        *users,
    )


def int_workout_recovery(
    workouts: DataFrame,
    daily: DataFrame,
    user_col: str | None = "user_id",
) -> DataFrame:
    """Each workout with its intense minutes and its user's recovery of the day after.

    Without ``user_col`` the join is on the date alone, and a date with the days of more users is an error.
    """
    workout = workouts.select(
        "workout_id",
        "user_id",
        "sport_id",
        "sport_name",
        "workout_start",
        "workout_end",
        "workout_date",
        "timezone_offset",
        "score_state",
        "strain_score",
        "avg_heart_rate",
        "max_heart_rate",
        "kilojoule",
        "pct_recorded",
        "distance_meter",
        "altitude_gain_meter",
        "altitude_change_meter",
        *[f"zone_{i}_min" for i in range(6)],
        labels.high_intensity_min("zone_3_min", "zone_4_min", "zone_5_min").alias("high_intensity_min"),
        "loaded_at",
    )
    joined = attach_day(workout, daily, NEXT_DAY, "workout_date", offset=1, user_col=user_col)
    return joined.select(*[c for c in joined.columns if c != "loaded_at"], "loaded_at")
