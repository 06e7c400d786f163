"""Marts: trends, users, facts, and the nightly build of all models."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from paceforge.operators import rolling
from paceforge.operators.aggregates import lifetime_stats
from paceforge.operators.joins import attach_one
from paceforge.operators.quality import NOT_NULL
from paceforge.operators.upsert import merge_mart, read_mart
from paceforge.plans import staging
from paceforge.plans.carried import read_load, refresh_load
from paceforge.plans.daily import int_daily_metrics
from paceforge.plans.load import fct_weekly_training_summary, int_training_load
from paceforge.plans.recovery import int_run_recovery, int_workout_recovery

STAMP = "dbt_updated_at"

# Averages of the trends, as (source, result, rows, digits).
TREND_AVERAGES = (
    ("recovery_score", "recovery_score_7d_avg", 7, 1),
    ("strain_score", "strain_score_7d_avg", 7, 1),
    ("sleep_performance_pct", "sleep_performance_7d_avg", 7, 1),
    ("total_sleep_hours", "sleep_hours_7d_avg", 7, 2),
    ("hrv_rmssd_milli", "hrv_7d_avg", 7, 1),
    ("resting_heart_rate", "resting_hr_7d_avg", 7, 1),
    ("recovery_score", "recovery_score_28d_avg", 28, 1),
    ("strain_score", "strain_score_28d_avg", 28, 1),
    ("sleep_performance_pct", "sleep_performance_28d_avg", 28, 1),
    ("hrv_rmssd_milli", "hrv_28d_avg", 28, 1),
)
TREND_DELTAS = (
    ("recovery_score", "recovery_score_dod"),
    ("strain_score", "strain_score_dod"),
    ("hrv_rmssd_milli", "hrv_dod"),
)


def stamp(df: DataFrame, now: datetime | Column | None = None) -> DataFrame:
    """Add the time of the build."""
    if now is None:
        at = F.current_timestamp()
    else:
        at = now if isinstance(now, Column) else F.lit(now).cast("timestamp")
    return df.withColumn(STAMP, at)


def my_trends(daily: DataFrame) -> DataFrame:
    """Daily values with rolling averages and day-over-day differences."""
    days = daily.where(F.col("cycle_date").isNotNull()).select(
        "cycle_id",
        "cycle_date",
        "user_id",
        "strain_score",
        "recovery_score",
        "sleep_performance_pct",
        "total_sleep_hours",
        "hrv_rmssd_milli",
        "resting_heart_rate",
        "sws_hours",
        "rem_hours",
        "recovery_bucket",
        "sleep_quality_label",
    )
    window = rolling.by_day("user_id", "cycle_date", "cycle_id")
    return days.select(
        *[c for c in days.columns if c != "cycle_id"],
        *[rolling.rolling_avg(c, window, rows, digits).alias(out) for c, out, rows, digits in TREND_AVERAGES],
        *[rolling.delta_prev(c, window).alias(out) for c, out in TREND_DELTAS],
    )


def dim_user(daily: DataFrame, users: DataFrame, now: datetime | Column | None = None) -> DataFrame:
    """Lifetime figures of every user with the profile."""
    profile = users.select("user_id", "first_name", "last_name", "email")
    return stamp(attach_one(lifetime_stats(daily), profile, "user_id"), now)


# Key and date of each incremental mart.
FACTS = {
    "fct_daily": ("int_daily_metrics", "cycle_id", "cycle_date"),
    "fct_runs": ("int_run_recovery", "run_id", "run_date"),
    "fct_workouts": ("int_workout_recovery", "workout_id", "workout_date"),
}


def write_model(
    df: DataFrame, table: str, buckets: int | None = None, bucket_by: str = "user_id", required: Sequence[str] = ()
) -> dict[str, int]:
    """Write a full table and return the number of NULLs in each required column, counted while writing.

    With ``buckets``, later work per user needs no shuffle.
    """
    nulls = Observation()
    if required:
        df = df.observe(nulls, *[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    writer = df.write.mode("overwrite")
    if buckets:
        writer = writer.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    writer.saveAsTable(table)
    return nulls.get if required else {}


def build(
    spark: SparkSession,
    raw: str = "default",
    models: str = "default",
    now: datetime | None = None,
    user_col: str | None = None,
    buckets: int | None = None,
    unique_days: bool = True,
    carry_load: bool = False,
) -> dict[str, dict[str, int]]:
    """Build all models from the raw tables: staging as views, the rest as tables.

    With ``carry_load`` the training load is kept from build to build, and only what follows a changed day is worked out again.

    ``int_daily_metrics`` has five readers and is written before any of them. Returns, for each model that is written in full,
    the NULLs in its required columns, for ``quality.check_models``.
    """
    nulls: dict[str, dict[str, int]] = {}

    def source(name: str) -> DataFrame:
        return spark.table(f"{raw}.{name}")

    def name_of(model: str) -> str:
        return f"{models}.{model}"

    def write(df: DataFrame, model: str, buckets: int | None = None) -> None:
        nulls[model] = write_model(df, name_of(model), buckets, required=NOT_NULL[model])

    spark.sql(f"CREATE DATABASE IF NOT EXISTS {models}")
    for model in ("raw_cycles", "raw_recoveries", "raw_sleeps", "raw_workouts", "raw_users"):
        view = getattr(staging, f"stg_{model}")(source(model))
        view.createOrReplaceTempView(f"stg_{model}")
    runs = staging.stg_strava_runs(source("raw_strava_runs"), source("raw_strava_photos"), user_col)
    runs.createOrReplaceTempView("stg_strava_runs")

    stg = spark.table
    daily = int_daily_metrics(stg("stg_raw_cycles"), stg("stg_raw_recoveries"), stg("stg_raw_sleeps"))
    write(daily, "int_daily_metrics", buckets)
    daily = spark.table(name_of("int_daily_metrics"))

    workouts = stg("stg_raw_workouts")
    write(int_run_recovery(stg("stg_strava_runs"), daily, workouts, user_col), "int_run_recovery")
    write(int_workout_recovery(workouts, daily), "int_workout_recovery", buckets)
    for fact, (model, key, date) in FACTS.items():
        merge_mart(stamp(spark.table(name_of(model)), now), name_of(fact), key, date)

    facts = read_mart(spark, name_of("fct_daily"))
    if carry_load:
        refresh_load(facts, name_of("int_training_load"), unique_days)
        load = read_load(spark, name_of("int_training_load"))
        missing = load.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in NOT_NULL["int_training_load"]])
        nulls["int_training_load"] = missing.first().asDict()
    else:
        write(int_training_load(facts, unique_days), "int_training_load", buckets)
        load = spark.table(name_of("int_training_load"))
    weekly = fct_weekly_training_summary(load, read_mart(spark, name_of("fct_runs")), user_col)
    write(weekly, "fct_weekly_training_summary")
    write(dim_user(daily, stg("stg_raw_users"), now), "dim_user")
    write(my_trends(daily), "my_trends")
    return nulls
