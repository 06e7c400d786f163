"""Staging models: versions, unpacking and units."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from paceforge.functions import units as u
from paceforge.operators.versions import latest_version
from paceforge.plans import staging
from paceforge.sources.schemas import raw_schema
from tests.conftest import rows

T1, T2 = datetime(2024, 6, 2), datetime(2024, 6, 3)


def raw(spark, table, *records):
    schema = raw_schema(table)
    full = [{field.name: record.get(field.name) for field in schema} for record in records]
    return spark.createDataFrame(full, schema)


def test_latest_version(spark):
    df = spark.createDataFrame(
        [(1, T1, "old"), (1, T2, "new"), (2, T1, "a"), (2, T1, "b"), (3, None, "x"), (3, T1, "y"), (None, T1, "n")],
        "k int, loaded_at timestamp, v string",
    )
    first = rows(latest_version(df, ["k"]).select("k", "v"))
    assert [r for r in first if r[0] != 2] == [(None, "n"), (1, "new"), (3, "y")]
    for shuffled in (df.orderBy("v"), df.orderBy(F.desc("v")), df.repartition(7)):
        assert rows(latest_version(shuffled, ["k"]).select("k", "v")) == first


def test_latest_version_equals_max_by(spark):
    df = spark.range(5000).select(
        (F.col("id") % 137).alias("k"),
        F.timestamp_seconds(F.pmod(F.hash("id"), F.lit(500))).alias("loaded_at"),
        "id",
    )
    picked = latest_version(df, ["k"], tiebreak=[F.desc("id")]).select("k", "id")
    other = df.groupBy("k").agg(F.max_by("id", F.struct("loaded_at", "id")).alias("id"))
    assert rows(picked) == rows(other)


def test_hot_key_is_limited_before_the_shuffle(spark):
    df = spark.createDataFrame([(i % 3, T1) for i in range(50)], "id int, loaded_at timestamp")
    text = latest_version(df, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in text and text.index("Final") < text.index("Partial")


def test_cycles(spark):
    score = {"strain": 14.5, "kilojoule": 8500.0, "average_heart_rate": 62, "max_heart_rate": 175}
    cycle = {"id": 1, "user_id": 9, "start": datetime(2024, 6, 1, 23, 30), "timezone_offset": "-05:00"}
    got = staging.stg_raw_cycles(
        raw(spark, "raw_cycles", {**cycle, "score": None, "loaded_at": T1}, {**cycle, "score": score, "loaded_at": T2})
    ).collect()
    assert len(got) == 1
    assert got[0].strain_score == 14.5 and got[0].kilojoule == 8500.0
    assert (got[0].avg_heart_rate, got[0].max_heart_rate) == (62, 175)
    assert got[0].cycle_date == date(2024, 6, 1)


def test_sleeps(spark):
    stage = {"total_in_bed_time_milli": 28800000, "total_awake_time_milli": 1200000, "sleep_cycle_count": 4}
    score = {"stage_summary": stage, "sleep_needed": {"baseline_milli": 25200000}}
    sleep = {"id": "s", "user_id": 9, "end": datetime(2024, 6, 2, 7), "score": score, "loaded_at": T1}
    got = staging.stg_raw_sleeps(raw(spark, "raw_sleeps", sleep)).first()
    assert got.in_bed_hours == 8.0 and got.awake_hours == 1200000 / 3600000.0
    assert got.sleep_needed_baseline_hours == 7.0 and got.rem_hours is None
    assert got.sleep_cycle_count == 4 and got.sleep_date == date(2024, 6, 2)


def test_workouts(spark):
    zones = {f"zone_{n}_milli": 60000 * i for i, n in enumerate(("zero", "one", "two", "three", "four", "five"))}
    scored = {"id": "a", "user_id": 9, "score": {"percent_recorded": 98.0, "zone_duration": zones}, "loaded_at": T1}
    bare = {"id": "b", "user_id": 9, "score": {"strain": 5.0}, "loaded_at": T1}
    got = {r.workout_id: r for r in staging.stg_raw_workouts(raw(spark, "raw_workouts", scored, bare)).collect()}
    assert [got["a"][f"zone_{i}_min"] for i in range(6)] == [0.0, 1.0, 2.0, 3.0, 4.0, 5.0]
    assert got["a"].pct_recorded == 0.98 and got["b"].zone_3_min is None


def test_runs(spark):
    run = {
        "id": 12345,
        "start_date": datetime(2024, 6, 1, 7),
        "distance_meter": 8200.0,
        "moving_time_sec": 2640,
        "average_speed_ms": 3.1,
        "max_speed_ms": 4.2,
        "loaded_at": T1,
    }
    still = {"id": 2, "distance_meter": 0.0, "moving_time_sec": 60, "loaded_at": T1}
    photos = raw(
        spark,
        "raw_strava_photos",
        {"id": 12345, "primary_photo_url": "old", "photo_count": 1, "loaded_at": T1},
        {"id": 12345, "primary_photo_url": "new", "photo_count": 2, "loaded_at": T2},
    )
    got = {r.run_id: r for r in staging.stg_strava_runs(raw(spark, "raw_strava_runs", run, still), photos).collect()}
    assert (got[12345].distance_km, got[12345].moving_time_min) == (8.2, 44.0)
    assert round(got[12345].pace_min_per_km, 3) == 5.366
    assert (got[12345].avg_speed_kmh, got[12345].max_speed_kmh) == (11.16, 15.12)
    assert (got[12345].primary_photo_url, got[12345].photo_count) == ("new", 2)
    assert got[12345].run_date == date(2024, 6, 1)
    assert got[2].pace_min_per_km is None and got[2].photo_count is None and got[2].run_date is None


def test_users(spark):
    old = {"user_id": 1, "first_name": "Old", "loaded_at": T1}
    new = {"user_id": 1, "first_name": "New", "loaded_at": T2}
    assert [r.first_name for r in staging.stg_raw_users(raw(spark, "raw_users", old, new)).collect()] == ["New"]


def test_period_keys(spark):
    days = spark.createDataFrame([(date(2027, 1, 1),), (date(2026, 12, 28),), (date(2024, 1, 1),)], "d date")
    keys = days.select(*[u.period_key("d", g) for g in u.PERIOD_GRAINS], u.week_start("d").cast("string")).collect()
    assert tuple(keys[0]) == ("2027", "2027-01", "2026-W53", "2027-01-01", "2026-12-28")
    assert tuple(keys[1]) == ("2026", "2026-12", "2026-W53", "2026-12-28", "2026-12-28")
    assert tuple(keys[2]) == ("2024", "2024-01", "2024-W01", "2024-01-01", "2024-01-01")
    with pytest.raises(ValueError):
        u.period_key("d", "decade")


def test_speeds_and_ratios(spark):
    df = spark.createDataFrame([(0.0, 5.0), (10.0, 0.0), (None, 1.0)], "kmh double, x double")
    got = df.select(u.speed_mph("kmh"), u.ratio("kmh", "x"), u.settled_round(F.lit(0.1) + F.lit(0.25) - F.lit(0.1), 1)).collect()
    assert [tuple(r) for r in got] == [(None, 0.0, 0.3), (6.21, None, 0.3), (None, None, 0.3)]
