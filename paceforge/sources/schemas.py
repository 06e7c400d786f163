"""Declared schemas of the raw tables, and of the JSON records that feed them."""

from __future__ import annotations

from pyspark.sql import types as T

# The column names, types and nullability of the raw tables.
_RAW_DDL = {
    "raw_cycles": """
        id BIGINT NOT NULL, user_id BIGINT NOT NULL, start TIMESTAMP, end TIMESTAMP,
        timezone_offset STRING, score_state STRING,
        score STRUCT<strain: DOUBLE, kilojoule: DOUBLE,
                     average_heart_rate: BIGINT, max_heart_rate: BIGINT>,
        loaded_at TIMESTAMP NOT NULL""",
    "raw_sleeps": """
        id STRING NOT NULL, cycle_id BIGINT, v1_id BIGINT, user_id BIGINT NOT NULL,
        start TIMESTAMP, end TIMESTAMP, timezone_offset STRING, nap BOOLEAN, score_state STRING,
        score STRUCT<
            stage_summary: STRUCT<
                total_in_bed_time_milli: BIGINT, total_awake_time_milli: BIGINT,
                total_no_data_time_milli: BIGINT, total_light_sleep_time_milli: BIGINT,
                total_slow_wave_sleep_time_milli: BIGINT, total_rem_sleep_time_milli: BIGINT,
                sleep_cycle_count: BIGINT, disturbance_count: BIGINT>,
            sleep_needed: STRUCT<
                baseline_milli: BIGINT, need_from_sleep_debt_milli: BIGINT,
                need_from_recent_strain_milli: BIGINT, need_from_recent_nap_milli: BIGINT>,
            respiratory_rate: DOUBLE, sleep_performance_percentage: DOUBLE,
            sleep_consistency_percentage: DOUBLE, sleep_efficiency_percentage: DOUBLE>,
        loaded_at TIMESTAMP NOT NULL""",
    "raw_recoveries": """
        cycle_id BIGINT NOT NULL, sleep_id STRING, user_id BIGINT NOT NULL,
        created_at TIMESTAMP, updated_at TIMESTAMP, score_state STRING,
        score STRUCT<user_calibrating: BOOLEAN, recovery_score: DOUBLE,
                     resting_heart_rate: DOUBLE, hrv_rmssd_milli: DOUBLE,
                     spo2_percentage: DOUBLE, skin_temp_celsius: DOUBLE>,
        loaded_at TIMESTAMP NOT NULL""",
    "raw_workouts": """
        id STRING NOT NULL, v1_id BIGINT, user_id BIGINT NOT NULL,
        start TIMESTAMP, end TIMESTAMP, timezone_offset STRING,
        sport_id BIGINT, sport_name STRING, score_state STRING,
        score STRUCT<
            strain: DOUBLE, average_heart_rate: BIGINT, max_heart_rate: BIGINT,
            kilojoule: DOUBLE, percent_recorded: DOUBLE, distance_meter: DOUBLE,
            altitude_gain_meter: DOUBLE, altitude_change_meter: DOUBLE,
            zone_duration: STRUCT<
                zone_zero_milli: BIGINT, zone_one_milli: BIGINT, zone_two_milli: BIGINT,
                zone_three_milli: BIGINT, zone_four_milli: BIGINT, zone_five_milli: BIGINT>>,
        loaded_at TIMESTAMP NOT NULL""",
    "raw_users": """
        user_id BIGINT NOT NULL, email STRING, first_name STRING, last_name STRING,
        loaded_at TIMESTAMP NOT NULL""",
    "raw_strava_photos": """
        id BIGINT NOT NULL, primary_photo_url STRING, photo_count BIGINT,
        loaded_at TIMESTAMP NOT NULL""",
    "raw_strava_runs": """
        id BIGINT NOT NULL, name STRING, sport_type STRING, start_date TIMESTAMP,
        distance_meter DOUBLE, moving_time_sec BIGINT, elapsed_time_sec BIGINT,
        total_elevation_gain_meter DOUBLE, average_speed_ms DOUBLE, max_speed_ms DOUBLE,
        average_heartrate DOUBLE, max_heartrate DOUBLE, average_cadence DOUBLE,
        suffer_score DOUBLE, summary_polyline STRING, loaded_at TIMESTAMP NOT NULL""",
    "pipeline_runs": """
        run_id STRING NOT NULL, endpoint STRING NOT NULL, started_at TIMESTAMP NOT NULL,
        ended_at TIMESTAMP, rows_fetched BIGINT, rows_inserted BIGINT,
        watermark_start TIMESTAMP, watermark_end TIMESTAMP, status STRING NOT NULL,
        error_msg STRING""",
}

AUDIT_TABLE = "pipeline_runs"
RAW_TABLES = tuple(_RAW_DDL)


def raw_schema(name: str) -> T.StructType:
    """Declared schema of a raw table; an unknown name raises ``KeyError``."""
    return T.StructType.fromDDL(_RAW_DDL[name])


def raw_field(table: str, path: str) -> T.DataType:
    """Type of a possibly nested raw field, such as ``score.stage_summary``."""
    found: T.DataType = raw_schema(table)
    for part in path.split("."):
        found = found[part].dataType
    return found


# Landed records keep ``score`` as JSON text: a missing score, ``null`` and ``{}`` all mean "no
# score", while ``{"strain": null}`` is a score, and a parsed struct could not tell them apart.
_LANDING_DDL = {
    "cycles": """
        id BIGINT, user_id BIGINT, start TIMESTAMP, end TIMESTAMP, timezone_offset STRING,
        score_state STRING, score STRING""",
    "sleeps": """
        id STRING, cycle_id BIGINT, v1_id BIGINT, user_id BIGINT, start TIMESTAMP, end TIMESTAMP,
        timezone_offset STRING, nap BOOLEAN, score_state STRING, score STRING""",
    "recoveries": """
        cycle_id BIGINT, sleep_id STRING, user_id BIGINT, created_at TIMESTAMP,
        updated_at TIMESTAMP, score_state STRING, score STRING""",
    "workouts": """
        id STRING, v1_id BIGINT, user_id BIGINT, start TIMESTAMP, end TIMESTAMP,
        timezone_offset STRING, sport_id BIGINT, sport_name STRING, score_state STRING,
        score STRING""",
    "runs": """
        id BIGINT, name STRING, sport_type STRING, start_date TIMESTAMP, distance DOUBLE,
        moving_time BIGINT, elapsed_time BIGINT, total_elevation_gain DOUBLE,
        average_speed DOUBLE, max_speed DOUBLE, average_heartrate DOUBLE, max_heartrate DOUBLE,
        average_cadence DOUBLE, suffer_score DOUBLE, map STRUCT<summary_polyline: STRING>""",
    "users": "user_id BIGINT, email STRING, first_name STRING, last_name STRING",
    "photos": "id BIGINT, photos ARRAY<STRUCT<urls: MAP<STRING, STRING>>>",
}


def landing_schema(kind: str) -> T.StructType:
    """Schema to read landed JSON of one kind with, so that nothing is inferred."""
    return T.StructType.fromDDL(_LANDING_DDL[kind])
