"""Staging models: flat, typed columns and the latest version of every record."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paceforge.functions import units as u
from paceforge.operators.joins import attach_one
from paceforge.operators.versions import latest_version


# Versions of a record that were loaded at one instant are told apart by these columns: those that
# later models join and filter on, and the main value, and then by a hash of the whole row.
_TIES = {
    "cycles": ("strain_score", "score_state", "cycle_start", "cycle_end"),
    "recoveries": ("updated_at", "recovery_score", "score_state"),
    "sleeps": ("in_bed_hours", "sleep_performance_pct", "sleep_end", "cycle_id", "is_nap"),
    "workouts": ("strain_score", "workout_start", "sport_name"),
    "runs": ("run_start", "distance_meter", "moving_time_sec", "average_speed_ms"),
}


def _latest(df: DataFrame, key: str, kind: str) -> DataFrame:
    """Latest version, the same whatever the order of the rows."""
    named = [F.col(c).desc_nulls_last() for c in _TIES[kind]]
    return latest_version(df, [key], tiebreak=[*named, F.xxhash64(*df.columns)])


def unpack(df: DataFrame, columns: Mapping[str, str | Column]) -> DataFrame:
    """Select nested fields and expressions under flat names, given as name to field."""
    return df.select(*[u.column(source).alias(name) for name, source in columns.items()])


def stg_raw_cycles(raw: DataFrame) -> DataFrame:
    flat = unpack(
        raw,
        {
            "cycle_id": "id",
            "user_id": "user_id",
            "cycle_start": "start",
            "cycle_end": "end",
            "timezone_offset": "timezone_offset",
            "score_state": "score_state",
            "strain_score": "score.strain",
            "kilojoule": "score.kilojoule",
            "avg_heart_rate": "score.average_heart_rate",
            "max_heart_rate": "score.max_heart_rate",
            "loaded_at": "loaded_at",
            "cycle_date": u.utc_date("start"),
        },
    )
    return _latest(flat, "cycle_id", "cycles")


def stg_raw_recoveries(raw: DataFrame) -> DataFrame:
    flat = unpack(
        raw,
        {
            "cycle_id": "cycle_id",
            "sleep_id": "sleep_id",
            "user_id": "user_id",
            "score_state": "score_state",
            "is_calibrating": "score.user_calibrating",
            "recovery_score": "score.recovery_score",
            "resting_heart_rate": "score.resting_heart_rate",
            "hrv_rmssd_milli": "score.hrv_rmssd_milli",
            "spo2_pct": "score.spo2_percentage",
            "skin_temp_celsius": "score.skin_temp_celsius",
            "created_at": "created_at",
            "updated_at": "updated_at",
            "loaded_at": "loaded_at",
            "recovery_date": u.utc_date("created_at"),
        },
    )
    return _latest(flat, "cycle_id", "recoveries")


def stg_raw_sleeps(raw: DataFrame) -> DataFrame:
    stage, need = "score.stage_summary", "score.sleep_needed"
    flat = unpack(
        raw,
        {
            "sleep_id": "id",
            "cycle_id": "cycle_id",
            "user_id": "user_id",
            "is_nap": "nap",
            "sleep_start": "start",
            "sleep_end": "end",
            "timezone_offset": "timezone_offset",
            "score_state": "score_state",
            "in_bed_hours": u.ms_to_hours(f"{stage}.total_in_bed_time_milli"),
            "awake_hours": u.ms_to_hours(f"{stage}.total_awake_time_milli"),
            "light_sleep_hours": u.ms_to_hours(f"{stage}.total_light_sleep_time_milli"),
            "sws_hours": u.ms_to_hours(f"{stage}.total_slow_wave_sleep_time_milli"),
            "rem_hours": u.ms_to_hours(f"{stage}.total_rem_sleep_time_milli"),
            "sleep_cycle_count": f"{stage}.sleep_cycle_count",
            "disturbance_count": f"{stage}.disturbance_count",
            "no_data_hours": u.ms_to_hours(f"{stage}.total_no_data_time_milli"),
            "sleep_needed_baseline_hours": u.ms_to_hours(f"{need}.baseline_milli"),
            "sleep_need_from_debt_hours": u.ms_to_hours(f"{need}.need_from_sleep_debt_milli"),
            "sleep_need_from_strain_hours": u.ms_to_hours(f"{need}.need_from_recent_strain_milli"),
            "sleep_need_from_nap_hours": u.ms_to_hours(f"{need}.need_from_recent_nap_milli"),
            "respiratory_rate": "score.respiratory_rate",
            "sleep_performance_pct": "score.sleep_performance_percentage",
            "sleep_consistency_pct": "score.sleep_consistency_percentage",
            "sleep_efficiency_pct": "score.sleep_efficiency_percentage",
            "loaded_at": "loaded_at",
            "sleep_date": u.utc_date("end"),
        },
    )
    return _latest(flat, "sleep_id", "sleeps")


def stg_raw_workouts(raw: DataFrame) -> DataFrame:
    zone_names = ("zero", "one", "two", "three", "four", "five")
    zones = {
        f"zone_{i}_min": u.ms_to_minutes(f"score.zone_duration.zone_{name}_milli")
        for i, name in enumerate(zone_names)
    }
    flat = unpack(
        raw,
        {
            "workout_id": "id",
            "user_id": "user_id",
            "sport_id": "sport_id",
            "sport_name": "sport_name",
            "workout_start": "start",
            "workout_end": "end",
            "timezone_offset": "timezone_offset",
            "score_state": "score_state",
            "strain_score": "score.strain",
            "avg_heart_rate": "score.average_heart_rate",
            "max_heart_rate": "score.max_heart_rate",
            "kilojoule": "score.kilojoule",
            "pct_recorded": u.percent_to_fraction("score.percent_recorded"),
            "distance_meter": "score.distance_meter",
            "altitude_gain_meter": "score.altitude_gain_meter",
            "altitude_change_meter": "score.altitude_change_meter",
            **zones,
            "loaded_at": "loaded_at",
            "workout_date": u.utc_date("start"),
        },
    )
    return _latest(flat, "workout_id", "workouts")


def stg_raw_users(raw: DataFrame) -> DataFrame:
    snapshots = raw.select("user_id", "email", "first_name", "last_name", "loaded_at")
    return latest_version(snapshots, ["user_id"])


def attach_photos(runs: DataFrame, photos: DataFrame) -> DataFrame:
    """Runs with the latest photo record of each."""
    latest = latest_version(photos, ["id"])
    return attach_one(
        runs, latest.select(F.col("id").alias("run_id"), "primary_photo_url", "photo_count"), "run_id"
    )


def derive_run_units(runs: DataFrame) -> DataFrame:
    """Distance in km, minutes, pace and speeds next to the measured values."""
    return runs.select(
        "*",
        u.metres_to_km("distance_meter").alias("distance_km"),
        u.seconds_to_minutes("moving_time_sec").alias("moving_time_min"),
        u.pace_min_per_km("moving_time_sec", "distance_meter").alias("pace_min_per_km"),
        u.speed_kmh("average_speed_ms").alias("avg_speed_kmh"),
        u.speed_kmh("max_speed_ms").alias("max_speed_kmh"),
    )


# Columns of the staged runs in order.
_RUN_COLUMNS = """
    run_id run_name sport_type run_start run_date distance_meter distance_km moving_time_sec
    elapsed_time_sec moving_time_min pace_min_per_km average_speed_ms max_speed_ms avg_speed_kmh
    max_speed_kmh total_elevation_gain_meter average_heartrate max_heartrate average_cadence
    suffer_score summary_polyline loaded_at
""".split()


def stg_strava_runs(raw_runs: DataFrame, raw_photos: DataFrame, user_col: str | None = None) -> DataFrame:
    """Latest version of every run with its photo; ``user_col`` keeps an owner column if there is one."""
    named = raw_runs.withColumnsRenamed({"id": "run_id", "name": "run_name", "start_date": "run_start"})
    dated = derive_run_units(named.withColumn("run_date", u.utc_date("run_start")))
    users = [user_col] if user_col else []
    return attach_photos(_latest(dated.select(*_RUN_COLUMNS, *users), "run_id", "runs"), raw_photos)
