"""Raw-shaped tables made from the driver's tables, row by row and over all of their rows.

Every event is a version of a cycle, a recovery, a sleep, a workout, a run and a profile, so that
the work of each model grows with ``events``. Numbers come from whole cents and whole counts, which
both engines add up exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paceforge.functions.labels import daily_load
from paceforge.session import utc
from paceforge.storage import stored


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return instants(utc(spark).read.parquet(f"{sf_dir}/{name}.parquet"))


def instants(df: DataFrame) -> DataFrame:
    """Times without a zone as instants."""
    times = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({name: F.col(name).cast("timestamp") for name in times})


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their day, whole cents, the count in ``props`` and a cycle id per user and day."""
    return read_events(table(spark, sf_dir, "events"))


def dealt_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events dealt evenly over all tasks and stored, for work that reads them many times.

    One task reads a whole row group, so a file of few row groups would leave each of those passes to few tasks.
    """
    return stored(events(spark, sf_dir).repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))))


def read_events(df: DataFrame) -> DataFrame:
    day = F.to_date("ts")
    return df.select(
        "event_id",
        "ts",
        day.alias("d"),
        "user_id",
        "event_type",
        F.round(F.col("value") * 100).cast("bigint").alias("cents"),
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        (F.col("user_id") * 1000000 + F.datediff(day, F.lit("2000-01-01").cast("date"))).alias("cycle"),
    )


def _over(c: Column, divisor: float) -> Column:
    return c.cast("double") / F.lit(divisor)


def _is(*types: str) -> Column:
    return F.col("event_type").isin(*types)


def raw_cycles(ev: DataFrame) -> DataFrame:
    """One version of the day's cycle per user, day and event type; errors are not yet scored."""
    sums = ev.groupBy("cycle", "user_id", "d", "event_type").agg(
        F.sum("cents").alias("cents"), F.sum("k").alias("k"), F.max("ts").alias("last_ts")
    )
    score = F.struct(
        _over(F.col("cents") % 2101, 100.0).alias("strain"),
        _over(F.col("cents"), 10.0).alias("kilojoule"),
        (F.col("k") % 50 + 50).alias("average_heart_rate"),
        (F.col("k") % 90 + 100).alias("max_heart_rate"),
    )
    return sums.select(
        F.col("cycle").alias("id"),
        "user_id",
        F.col("d").cast("timestamp").alias("start"),
        F.col("last_ts").alias("end"),
        F.lit("+00:00").alias("timezone_offset"),
        F.when(_is("error"), "PENDING_SCORE").otherwise("SCORED").alias("score_state"),
        F.when(~_is("error"), score).alias("score"),
        F.col("last_ts").alias("loaded_at"),
    )


def load_rows(ev: DataFrame) -> DataFrame:
    """Every event as a row of the training load, with its instant; errors have no strain, signups no recovery."""
    strain = F.when(~_is("error"), _over(F.col("cents") % 2101, 100.0))
    labels = {"form_label": F.concat(F.lit("form"), (F.col("k") % 5).cast("string")), "fitness_phase": F.when(F.col("k") >= 10, F.col("event_type"))}
    return ev.withColumn("strain_score", strain).select(
        "event_id",
        "ts",
        "user_id",
        daily_load("strain_score").alias("daily_tss"),
        "strain_score",
        F.when(~_is("signup"), _over(F.col("k") % 101, 1.0)).alias("recovery_score"),
        _over(F.col("cents") % 12000, 100.0).alias("hrv_rmssd_milli"),
        _over(F.col("k") % 25 + 40, 1.0).alias("resting_heart_rate"),
        *[_over(F.col("cents") % n, 10.0).alias(name) for name, n in (("ctl", 700), ("atl", 1100), ("tsb", 300))],
        *[c.alias(name) for name, c in labels.items()],
        _over(F.col("k") % 30, 10.0).alias("training_monotony_7d"),
    )


def raw_recoveries(ev: DataFrame) -> DataFrame:
    """One version per user, day and event type; error events make none, signups have no score."""
    sums = ev.where(~_is("error")).groupBy("cycle", "user_id", "event_type").agg(
        F.sum("cents").alias("cents"),
        F.sum("k").alias("k"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
    )
    score = F.struct(
        _is("view").alias("user_calibrating"),
        _over(F.col("k") % 101, 1.0).alias("recovery_score"),
        _over(F.col("k") % 25 + 40, 1.0).alias("resting_heart_rate"),
        _over(F.col("cents") % 12000, 100.0).alias("hrv_rmssd_milli"),
        _over(F.col("cents") % 100 + 900, 10.0).alias("spo2_percentage"),
        _over(F.col("cents") % 40 + 320, 10.0).alias("skin_temp_celsius"),
    )
    return sums.select(
        F.col("cycle").alias("cycle_id"),
        F.concat_ws("-", "cycle", "event_type").alias("sleep_id"),
        "user_id",
        F.col("first_ts").alias("created_at"),
        F.col("last_ts").alias("updated_at"),
        F.when(_is("signup"), "UNSCORABLE").otherwise("SCORED").alias("score_state"),
        F.when(~_is("signup"), score).alias("score"),
        F.col("last_ts").alias("loaded_at"),
    )


def raw_sleeps(ev: DataFrame) -> DataFrame:
    """Every event is a version of the sleep of its user, day and type; clicks are naps."""
    ms = F.col("cents") * 977
    stage = F.struct(
        (ms % 18000000 + 18000000).alias("total_in_bed_time_milli"),
        F.when(F.col("k") >= 10, F.col("k") * 60000).alias("total_awake_time_milli"),
        (F.col("k") * 1000).alias("total_no_data_time_milli"),
        (ms % 9000000).alias("total_light_sleep_time_milli"),
        (ms % 7000000).alias("total_slow_wave_sleep_time_milli"),
        (ms % 5000000).alias("total_rem_sleep_time_milli"),
        (F.col("k") % 7).alias("sleep_cycle_count"),
        (F.col("k") % 11).alias("disturbance_count"),
    )
    need = F.struct(
        (F.col("k") * 360000).alias("baseline_milli"),
        (F.col("k") * 3600).alias("need_from_sleep_debt_milli"),
        (F.col("k") * 1800).alias("need_from_recent_strain_milli"),
        (F.col("k") * -900).alias("need_from_recent_nap_milli"),
    )
    score = F.struct(
        stage.alias("stage_summary"),
        need.alias("sleep_needed"),
        _over(F.col("k") % 8 + 12, 1.0).alias("respiratory_rate"),
        _over(F.col("cents") % 101, 1.0).alias("sleep_performance_percentage"),
        _over(F.col("k"), 1.0).alias("sleep_consistency_percentage"),
        _over(F.col("cents") % 1000, 10.0).alias("sleep_efficiency_percentage"),
    )
    return ev.select(
        F.concat_ws("-", "cycle", "event_type").alias("id"),
        F.col("cycle").alias("cycle_id"),
        F.col("event_id").alias("v1_id"),
        "user_id",
        F.col("d").cast("timestamp").alias("start"),
        F.col("ts").alias("end"),
        F.lit("+00:00").alias("timezone_offset"),
        F.when(_is("click"), True).when(_is("signup"), F.lit(None)).otherwise(False).alias("nap"),
        F.lit("SCORED").alias("score_state"),
        score.alias("score"),
        F.col("ts").alias("loaded_at"),
    )


def raw_workouts(ev: DataFrame) -> DataFrame:
    """Two neighbouring events of one user are versions of a workout; errors have no score."""
    zones = F.struct(
        *[
            (F.col("k") * 1000 * (i + 1)).alias(f"zone_{name}_milli")
            for i, name in enumerate(("zero", "one", "two", "three", "four", "five"))
        ]
    )
    score = F.struct(
        _over(F.col("cents") % 2101, 100.0).alias("strain"),
        (F.col("k") + 90).alias("average_heart_rate"),
        (F.col("k") + 120).alias("max_heart_rate"),
        _over(F.col("cents"), 10.0).alias("kilojoule"),
        _over(F.col("k"), 1.0).alias("percent_recorded"),
        _over(F.col("cents") * 3, 1.0).alias("distance_meter"),
        _over(F.col("k"), 2.0).alias("altitude_gain_meter"),
        _over(F.col("k") - 50, 2.0).alias("altitude_change_meter"),
        F.when(F.col("k") >= 20, zones).alias("zone_duration"),
    )
    sport = (
        F.when(_is("click"), "Running")
        .when(_is("view"), "trail run")
        .when(_is("purchase"), "Cycling")
        .when(_is("signup"), "RUNNING")
    )
    return ev.select(
        F.concat_ws("-", "user_id", F.floor(F.col("event_id") / 2)).alias("id"),
        F.col("event_id").alias("v1_id"),
        "user_id",
        F.col("ts").alias("start"),
        (F.col("ts") + F.make_dt_interval(mins=F.col("k").cast("int"))).alias("end"),
        F.lit("+00:00").alias("timezone_offset"),
        (F.col("k") % 5).alias("sport_id"),
        sport.alias("sport_name"),
        F.when(_is("error"), "PENDING_SCORE").otherwise("SCORED").alias("score_state"),
        F.when(~_is("error"), score).alias("score"),
        F.col("ts").alias("loaded_at"),
    )


def raw_users(ev: DataFrame) -> DataFrame:
    """Every event is a profile snapshot of its user."""
    return ev.select(
        "user_id",
        F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit("@example.org")).alias("email"),
        F.col("event_type").alias("first_name"),
        F.concat(F.lit("U"), F.col("k").cast("string")).alias("last_name"),
        F.col("ts").alias("loaded_at"),
    )


def _encoded_lines(cents: pa.Array, k: pa.Array) -> pa.Array:
    """The made route of each event as an encoded line; point i of 2 + k % 7, in 1e-5 degrees.

    lat = 4000000 + (cents * (i + 1) * 31) % 2000 - 1000
    lng = -7000000 + (k * (i + 1) * 37) % 3000 - 1500
    """
    cents, k = np.asarray(cents, dtype=np.int64), np.asarray(k, dtype=np.int64)
    sizes = k % 7 + 2
    row = np.repeat(np.arange(len(k)), sizes)
    i = np.arange(len(row)) - np.repeat(sizes.cumsum() - sizes, sizes)
    lat = 4000000 + cents[row] * (i + 1) * 31 % 2000 - 1000
    lng = -7000000 + k[row] * (i + 1) * 37 % 3000 - 1500
    points = np.stack([lat, lng], axis=1)
    steps = points - np.where((i > 0)[:, None], np.roll(points, 1, axis=0), 0)

    # Sign in the low bit; then five bits per character, low bits first, 32 on all but the last.
    numbers = np.where(steps < 0, ~(steps << 1), steps << 1).reshape(-1)
    rest = numbers[:, None] >> (5 * np.arange(7))
    used = (rest > 0) | (np.arange(7) == 0)
    characters = (rest & 31) + 32 * (rest > 31) + 63
    text = characters[used].astype(np.uint8)
    lengths = np.bincount(np.repeat(row, 2), weights=used.sum(axis=1), minlength=len(k))
    offsets = np.concatenate([[0], lengths.cumsum()]).astype(np.int32)
    return pa.StringArray.from_buffers(len(k), pa.py_buffer(offsets), pa.py_buffer(text))


def _line() -> Column:
    @F.arrow_udf("string")
    def encode(cents: pa.Array, k: pa.Array) -> pa.Array:
        return _encoded_lines(cents, k)

    return encode.asNondeterministic()("cents", "k")


def raw_runs(ev: DataFrame) -> DataFrame:
    """Every event is a run; signups have no route and errors an empty one."""
    sport = F.when(_is("click"), "TrailRun").when(_is("view"), "VirtualRun").otherwise("Run")
    line = F.when(_is("signup"), F.lit(None)).when(_is("error"), "").otherwise(F.col("line"))
    return ev.withColumn("line", _line()).select(
        F.col("event_id").alias("id"),
        F.concat_ws(" ", F.lit("Run"), "event_id").alias("name"),
        sport.alias("sport_type"),
        F.col("ts").alias("start_date"),
        _over(F.col("cents") % 500 * 10, 1.0).alias("distance_meter"),
        (F.col("k") * 60).alias("moving_time_sec"),
        (F.col("k") * 66).alias("elapsed_time_sec"),
        _over(F.col("k"), 2.0).alias("total_elevation_gain_meter"),
        _over(F.col("cents") % 6000, 1000.0).alias("average_speed_ms"),
        _over(F.col("cents") % 9000, 1000.0).alias("max_speed_ms"),
        F.when(F.col("k") >= 10, _over(F.col("k") + 80, 1.0)).alias("average_heartrate"),
        F.when(F.col("k") >= 10, _over(F.col("k") + 110, 1.0)).alias("max_heartrate"),
        _over(F.col("k") + 60, 1.0).alias("average_cadence"),
        _over(F.col("k"), 4.0).alias("suffer_score"),
        line.alias("summary_polyline"),
        F.col("ts").alias("loaded_at"),
        "user_id",
    )


def raw_photos(ev: DataFrame) -> DataFrame:
    """Two versions of the photo record of each run that is no error, of clicks without a url."""
    versions = F.explode(F.array(F.lit(0), F.lit(1))).alias("version")
    return ev.where(~_is("error")).select("*", versions).select(
        F.col("event_id").alias("id"),
        F.when(
            ~_is("click"),
            F.concat(F.lit("https://photos.example/"), F.concat_ws("/", "event_id", "version")),
        ).alias("primary_photo_url"),
        F.when(_is("click"), 0).otherwise(F.col("k") % 4 + F.col("version")).cast("bigint").alias("photo_count"),
        (F.col("ts") + F.make_dt_interval(hours=F.col("version"))).alias("loaded_at"),
    )
