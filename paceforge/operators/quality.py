"""Data-quality checks as DataFrame jobs; every check gives the number of failures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns that must not be NULL, and keys that must be unique, per model.
NOT_NULL = {
    "stg_raw_cycles": ("cycle_id", "user_id", "cycle_date"),
    "stg_raw_sleeps": ("sleep_id", "user_id"),
    "stg_raw_recoveries": ("cycle_id", "user_id"),
    "stg_raw_workouts": ("workout_id", "user_id"),
    "stg_strava_runs": ("run_id", "run_date"),
    "stg_raw_users": ("user_id",),
    "int_daily_metrics": ("cycle_id", "user_id", "cycle_date"),
    "int_run_recovery": ("run_id", "run_date"),
    "int_workout_recovery": ("workout_id", "user_id", "workout_date"),
    "int_training_load": ("cycle_date", "user_id"),
    "fct_daily": ("cycle_id", "user_id", "cycle_date"),
    "dim_user": ("user_id",),
    "fct_runs": ("run_id", "run_date"),
    "fct_workouts": ("workout_id", "user_id", "workout_date"),
    "my_trends": ("cycle_date", "user_id"),
    "fct_weekly_training_summary": ("week_start", "user_id"),
}
UNIQUE = {
    "stg_raw_cycles": ("cycle_id",),
    "stg_raw_sleeps": ("sleep_id",),
    "stg_raw_recoveries": ("cycle_id",),
    "stg_raw_workouts": ("workout_id",),
    "stg_strava_runs": ("run_id",),
    "stg_raw_users": ("user_id",),
    "int_daily_metrics": ("cycle_id",),
    "int_run_recovery": ("run_id",),
    "int_workout_recovery": ("workout_id",),
    "fct_daily": ("cycle_id",),
    "dim_user": ("user_id",),
    "fct_runs": ("run_id",),
    "fct_workouts": ("workout_id",),
}
# Grains the models state, beyond the declared unique keys.
GRAIN = {
    "int_training_load": ("user_id", "cycle_date"),
    "my_trends": ("user_id", "cycle_date"),
    "fct_weekly_training_summary": ("user_id", "week_start"),
}


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of NULLs in each column, in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("columns"), F.col(c).alias("failures")) for c in columns]
    )
    return counts.select(F.inline(pairs)).select(F.lit("not_null").alias("check"), "columns", "failures")


def check_unique(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of keys that occur more than once; keys with a NULL part are left to not_null."""
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    repeated = df.where(present).groupBy(*columns).count().where(F.col("count") > 1)
    return repeated.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit("unique").alias("check"), F.lit(", ".join(columns)).alias("columns"), "failures"
    )


def check_model(df: DataFrame, model: str) -> DataFrame:
    """All checks of one model in one pass: rows and NULLs per key, then their totals."""
    key, columns = UNIQUE.get(model) or GRAIN[model], NOT_NULL[model]
    places = [f"__null_{i}" for i in range(len(columns))]
    per_key = df.groupBy(*key).agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(F.col(c).isNull()).alias(place) for c, place in zip(columns, places)],
    )
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key])
    totals = per_key.agg(
        F.count_if(present & (F.col("__rows") > 1)).alias("__repeated"),
        *[F.coalesce(F.sum(place), F.lit(0)).alias(place) for place in places],
    )
    results = [("not_null", c, place) for c, place in zip(columns, places)] + [("unique", ", ".join(key), "__repeated")]
    shown = [
        F.struct(F.lit(check).alias("check"), F.lit(names).alias("columns"), F.col(place).alias("failures"))
        for check, names, place in results
    ]
    return totals.select(F.inline(F.array(*shown))).select(F.lit(model).alias("model"), "check", "columns", "failures")


def check_models(spark: SparkSession, database: str, nulls: Mapping[str, Mapping[str, int]] | None = None) -> DataFrame:
    """All declared checks on what a build has left: the staging views and the tables in ``database``.

    ``nulls`` are the counts that the build has made while it wrote; those models are read for their keys alone.
    """
    reports = []
    for name, columns in NOT_NULL.items():
        df = spark.table(name if name.startswith("stg_") else f"{database}.{name}")
        counted = (nulls or {}).get(name)
        if counted is None:
            reports.append(check_model(df, name))
            continue
        unique = check_unique(df, UNIQUE.get(name) or GRAIN[name]).withColumn("model", F.lit(name))
        known = [(name, "not_null", c, counted[c]) for c in columns]
        schema = "model string, check string, columns string, failures long"
        reports.append(spark.createDataFrame(known, schema).unionByName(unique))
    return reduce(DataFrame.unionByName, reports)
