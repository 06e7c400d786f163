"""Landed JSON records, conformed to the raw tables.

Everything here is a projection: executors parse the records, and no row meets another.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paceforge.sources.schemas import landing_schema, raw_field, raw_schema

# Fixed values.
RUN_SPORTS = ("Run", "TrailRun", "VirtualRun")
PHOTO_SIZES = ("600", "100")
RUN_FIELDS = {
    "distance": "distance_meter",
    "moving_time": "moving_time_sec",
    "elapsed_time": "elapsed_time_sec",
    "total_elevation_gain": "total_elevation_gain_meter",
    "average_speed": "average_speed_ms",
    "max_speed": "max_speed_ms",
    "map.summary_polyline": "summary_polyline",
}


def read_landing(spark: SparkSession, kind: str, path: str) -> DataFrame:
    """Read JSON lines of one kind with the declared schema."""
    return spark.read.schema(landing_schema(kind)).json(path)


def _object_or_null(text: Column) -> Column:
    """JSON text of a non-empty object, else NULL."""
    return F.when(F.size(F.json_object_keys(text)) > 0, text)


def _loaded(loaded_at: datetime | Column) -> Column:
    return loaded_at if isinstance(loaded_at, Column) else F.lit(loaded_at).cast("timestamp")


def _conform(df: DataFrame, table: str, loaded_at: datetime | Column) -> DataFrame:
    stamped = df.withColumn("loaded_at", _loaded(loaded_at))
    return stamped.select(
        *[F.col(field.name).cast(field.dataType).alias(field.name) for field in raw_schema(table)]
    )


def _with_fields(parsed: Column, wanted: T.StructType) -> Column:
    """All wanted fields of a parsed struct; inner structs are there even when all NULL."""
    fields = []
    for field in wanted:
        inner = parsed[field.name]
        if isinstance(field.dataType, T.StructType):
            inner = _with_fields(inner, field.dataType)
        fields.append(inner.alias(field.name))
    return F.struct(*fields)


def _with_parsed(df: DataFrame, text: Column, kind: T.StructType, out: str) -> DataFrame:
    """Add the parsed object ``out``, NULL where the text is no object or an empty one.

    Text and object are columns of their own, so that each is worked out once per record and not
    once per field.
    """
    texts = df.withColumn(f"{out}_text", _object_or_null(text))
    return texts.withColumn(out, F.from_json(f"{out}_text", kind))


def _conform_scored(df: DataFrame, table: str, loaded_at: datetime | Column) -> DataFrame:
    wanted = raw_field(table, "score")
    parsed = _with_parsed(df, F.col("score"), wanted, "__score")
    score = F.when(F.col("__score_text").isNotNull(), _with_fields(F.col("__score"), wanted))
    return _conform(parsed.withColumn("score", score), table, loaded_at)


def conform_cycles(df: DataFrame, loaded_at: datetime | Column) -> DataFrame:
    """Cycle records; a part score gives NULL fields, a missing or empty one a NULL score."""
    return _conform_scored(df, "raw_cycles", loaded_at)


def conform_sleeps(df: DataFrame, loaded_at: datetime | Column) -> DataFrame:
    """Sleep records; with a score, the stage and need structs always exist."""
    return _conform_scored(df, "raw_sleeps", loaded_at)


def conform_recoveries(df: DataFrame, loaded_at: datetime | Column) -> DataFrame:
    return _conform_scored(df, "raw_recoveries", loaded_at)


def conform_workouts(df: DataFrame, loaded_at: datetime | Column) -> DataFrame:
    """Workout records; zones come under either of two names, or not at all."""
    wanted = raw_field("raw_workouts", "score")
    plain = [field for field in wanted if field.name != "zone_duration"]
    zones_as_text = [T.StructField(name, T.StringType()) for name in ("zone_durations", "zone_duration")]
    parsed = _with_parsed(df, F.col("score"), T.StructType(plain + zones_as_text), "__score")
    zones = F.coalesce(
        _object_or_null(F.col("__score.zone_durations")), _object_or_null(F.col("__score.zone_duration"))
    )
    zoned = _with_parsed(parsed, zones, raw_field("raw_workouts", "score.zone_duration"), "__zones")
    score = F.struct(
        *[F.col(f"__score.{field.name}") for field in plain], F.col("__zones").alias("zone_duration")
    )
    scored = zoned.withColumn("score", F.when(F.col("__score_text").isNotNull(), score))
    return _conform(scored, "raw_workouts", loaded_at)


def only_runs(df: DataFrame) -> DataFrame:
    """Keep the activities that are runs."""
    return df.where(F.col("sport_type").isin(*RUN_SPORTS))


def conform_runs(df: DataFrame, loaded_at: datetime | Column) -> DataFrame:
    """Run records, with measures renamed to carry their unit and the route line lifted out."""
    renamed = df.select("*", *[F.col(source).alias(out) for source, out in RUN_FIELDS.items()])
    return _conform(renamed, "raw_strava_runs", loaded_at)


def conform_users(df: DataFrame, loaded_at: datetime | Column) -> DataFrame:
    """Profile snapshots, one per user and load."""
    return _conform(df, "raw_users", loaded_at)


def conform_photos(df: DataFrame, loaded_at: datetime | Column) -> DataFrame:
    """First usable photo url of each run and the number of photos; none gives (NULL, 0)."""
    urls = F.transform(
        F.coalesce(F.col("photos"), F.array().cast(df.schema["photos"].dataType)),
        lambda photo: F.coalesce(
            *[F.nullif(F.get(F.map_values(F.map_filter(photo["urls"], _is(size))), F.lit(0)), F.lit("")) for size in PHOTO_SIZES]
        ),
    )
    described = df.select(
        "*",
        F.get(F.filter(urls, lambda url: url.isNotNull()), F.lit(0)).alias("primary_photo_url"),
        F.size(urls).alias("photo_count"),
    )
    return _conform(described, "raw_strava_photos", loaded_at)


def _is(size: str):
    return lambda name, _: name == size


CONFORM = {
    "cycles": conform_cycles,
    "sleeps": conform_sleeps,
    "recoveries": conform_recoveries,
    "workouts": conform_workouts,
    "runs": conform_runs,
    "users": conform_users,
    "photos": conform_photos,
}
