"""Joins around activities, and the ways past hot keys, against plain and brute-force forms."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pyspark.errors import PySparkException

from paceforge.operators.joins import attach_day, attach_days, missing_keys
from paceforge.operators.nearest import nearest_match
from paceforge.plans.recovery import int_run_recovery, int_workout_recovery
from tests.conftest import rows

DAY = date(2024, 6, 1)


def test_attach_day(spark):
    acts = spark.createDataFrame([(1, DAY), (2, DAY + timedelta(5)), (3, None)], "id int, d date")
    daily = spark.createDataFrame([(DAY, 1, 60.0), (DAY + timedelta(1), 2, 70.0), (None, 3, 1.0)], "cycle_date date, u int, score double")
    same = attach_day(acts, daily, {"score": "same"}, "d")
    both = attach_day(same, daily, {"score": "next"}, "d", offset=1)
    assert rows(both.select("id", "same", "next")) == [(1, 60.0, 70.0), (2, None, None), (3, None, None)]


@pytest.mark.parametrize("user_col", ["u", None])
def test_one_look_up_equals_one_join_for_each_day(spark, user_col):
    rng = random.Random(6)
    days = [(DAY + timedelta(i), u, rng.choice([None, float(i)]), i) for i in range(20) for u in (range(3) if user_col else [0]) for _ in range(rng.choice([0, 1, 2] if user_col else [0, 1]))]
    days += [(None, 1, 5.0, 99)]
    acts = [(i, rng.choice([0, 1, 2, 7, None]), rng.choice([None, DAY + timedelta(rng.randrange(-2, 24))])) for i in range(200)]
    acts = spark.createDataFrame(acts, "id int, u int, d date")
    daily = spark.createDataFrame(days, "cycle_date date, u int, score double, c int")
    columns = {0: {"score": "same", "c": "same_c"}, 1: {"score": "next", "c": "next_c"}, -2: {"c": "before"}}
    both = acts
    for offset, names in columns.items():
        both = attach_day(both, daily, names, "d", offset=offset, user_col=user_col)
    once = attach_days(acts, daily, columns, "d", user_col=user_col)
    assert once.columns == both.columns and rows(once) == rows(both)
    assert once._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1


def test_two_users_on_a_date_need_a_user_key(spark):
    acts = spark.createDataFrame([(1, 1, DAY)], "id int, u int, d date")
    daily = spark.createDataFrame([(DAY, 1, 60.0), (DAY, 2, 70.0)], "cycle_date date, u int, score double")
    with pytest.raises(PySparkException, match="more than one day on 2024-06-01"):
        attach_day(acts, daily, {"score": "s"}, "d").collect()
    with pytest.raises(PySparkException, match="more than one day on 2024-06-01"):
        attach_days(acts, daily, {0: {"score": "s"}, 1: {"score": "n"}}, "d").collect()
    keyed = attach_day(acts, daily, {"score": "s"}, "d", user_col="u")
    assert rows(keyed.select("id", "s")) == [(1, 60.0)]


def moments(rng, n, spread):
    start = datetime(2024, 6, 1)
    return [start + timedelta(seconds=rng.randrange(spread), microseconds=rng.randrange(3)) for _ in range(n)]


@pytest.mark.parametrize("slices", [1, 7, 90])
def test_nearest_equals_brute_force(spark, slices):
    rng = random.Random(slices)
    left = [(i, rng.choice(["a", "a", "a", "b", "c", None]), t) for i, t in enumerate(moments(rng, 300, 9000))]
    right = [(i, rng.choice(["a", "a", "a", "b", None]), t, rng.random() < 0.7) for i, t in enumerate(moments(rng, 200, 9000))]
    right += [(1000 + i, g, left[i][2], True) for i, g in enumerate("aab")]
    got = nearest_match(
        spark.createDataFrame(left, "id long, g string, ts timestamp").repartition(3),
        spark.createDataFrame(right, "rid long, g string, rts timestamp, ok boolean").repartition(3),
        on=["g"],
        left_ts="ts",
        right_ts="rts",
        right_key="rid",
        columns={"rid": "match", "rts": "match_ts"},
        pred=F.col("ok"),
        slices=slices,
    )

    def best(group, ts):
        fits = [(abs(r[2] - ts), r[2] > ts, r[0], r[2]) for r in right if group and r[1] == group and r[3]]
        chosen = min(fits, default=None)
        minutes = [f[0] // timedelta(minutes=1) for f in fits]
        assert chosen is None or chosen[0] // timedelta(minutes=1) == min(minutes)
        return (chosen[2], chosen[3]) if chosen else (None, None)

    assert rows(got, "id") == [(i, g, ts, *best(g, ts)) for i, g, ts in left]


def test_missing_keys(spark):
    left = spark.createDataFrame([(3,), (1,), (3,), (2,)], "id long")
    right = spark.createDataFrame([(2,), (2,), (9,)], "id long")
    assert [r[0] for r in missing_keys(left, right, "id").collect()] == [1, 3]


def recovery_input(spark):
    noon = datetime(2024, 6, 1, 12)
    runs = spark.createDataFrame([(1, noon, DAY), (2, noon + timedelta(3), DAY + timedelta(3)), (3, None, None)], "run_id long, run_start timestamp, run_date date")
    empty = """distance_km moving_time_min pace_min_per_km avg_speed_kmh total_elevation_gain_meter average_heartrate
        max_heartrate average_cadence suffer_score""".split()
    runs = runs.withColumns({c: F.lit(None).cast("double") for c in empty}).withColumns(
        {c: F.lit(None).cast("string") for c in ("run_name", "sport_type", "summary_polyline", "primary_photo_url")}
    )
    runs = runs.withColumn("loaded_at", F.lit(noon))
    daily = spark.createDataFrame(
        [(11, DAY, 12.0, 60, 50.0, "optimal"), (12, DAY + timedelta(1), 8.0, 55, 71.5, "peak")],
        "cycle_id long, cycle_date date, strain_score double, cycle_avg_heart_rate long, recovery_score double, recovery_bucket string",
    ).withColumns({c: F.lit(None).cast("double") for c in ("hrv_rmssd_milli", "sleep_performance_pct", "total_sleep_hours", "resting_heart_rate")})
    daily = daily.withColumn("sleep_quality_label", F.lit("good"))
    workouts = spark.createDataFrame(
        [("before", "Trail RUN", noon - timedelta(minutes=7), 5.0, None, 2.0), ("after", "running", noon + timedelta(minutes=5), 10.0, 5.0, 12.0),
         ("ride", "cycling", noon, 1.0, 1.0, 1.0), ("nameless", None, noon, 1.0, 1.0, 1.0)],
        "workout_id string, sport_name string, workout_start timestamp, zone_3_min double, zone_4_min double, zone_5_min double",
    )
    workouts = workouts.withColumn("workout_date", F.to_date("workout_start")).withColumn("loaded_at", F.lit(noon))
    workouts = workouts.withColumns({c: F.lit(1).cast("double") for c in ("strain_score", "avg_heart_rate", "max_heart_rate", "distance_meter")})
    rest = "kilojoule pct_recorded altitude_gain_meter altitude_change_meter zone_0_min zone_1_min zone_2_min".split()
    workouts = workouts.withColumns({c: F.lit(None).cast("double") for c in rest})
    workouts = workouts.withColumns({c: F.lit(None).cast("string") for c in ("user_id", "sport_id", "workout_end", "timezone_offset", "score_state")})
    return runs, daily, workouts


def test_run_recovery(spark):
    runs, daily, workouts = recovery_input(spark)
    got = {r.run_id: r for r in int_run_recovery(runs, daily, workouts).collect()}
    assert sorted(got) == [1, 2, 3]
    first = got[1]
    assert (first.same_day_cycle_id, first.same_day_recovery, first.same_day_strain) == (11, 50.0, 12.0)
    assert (first.next_day_cycle_id, first.next_day_recovery_bucket, first.recovery_delta) == (12, "peak", 21.5)
    assert (first.matched_workout_id, first.matched_high_intensity_min) == ("after", 27.0)
    for lonely in (got[2], got[3]):
        assert lonely.same_day_cycle_id is None and lonely.recovery_delta is None
        assert (lonely.matched_workout_id, lonely.matched_high_intensity_min) == (None, 0.0)


def test_run_recovery_names(spark):
    got = int_run_recovery(*recovery_input(spark), match_prefix="device_")
    assert len(got.columns) == 42
    assert "device_workout_id" in got.columns and got.columns[-1] == "loaded_at"


def test_workout_recovery(spark):
    _, daily, workouts = recovery_input(spark)
    daily = daily.withColumn("user_id", F.lit("u"))
    others = daily.withColumns({"user_id": F.lit("v"), "recovery_score": F.lit(1.0)})
    workouts = workouts.withColumn("user_id", F.lit("u"))
    got = {r.workout_id: r for r in int_workout_recovery(workouts, daily.unionByName(others)).collect()}
    assert len(got) == 4 and got["before"].high_intensity_min == 7.0 and got["after"].high_intensity_min == 27.0
    assert got["ride"].next_day_recovery == 71.5 and got["ride"].next_day_cycle_id == 12
