"""Daily metrics, training load, weekly summary, trends and users."""

import math
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from paceforge.functions import labels
from paceforge.operators import aggregates, rolling
from paceforge.operators.load import ewma_load
from paceforge.plans import marts
from paceforge.plans.daily import int_daily_metrics
from paceforge.plans.load import fct_weekly_training_summary, int_training_load
from tests.conftest import rows

# Published strain, load and wellness of one user, and what the models make of them.
FIRST, SECOND = date(2026, 6, 15), date(2026, 6, 23)
STRAIN = [
    0.0, 0.013314305, 12.255827, 8.556715, 14.28817, 10.8201275, 15.218983, 12.614266, 10.489662,
    16.493214, 5.581828, 11.817896, 12.75337, 17.528688, 16.21192, 10.077527, 15.8283825, 7.44294,
    15.912541, 7.362273, 18.637075,
]
TSS = [
    0.0, 0.06, 58.36, 40.75, 68.04, 51.52, 72.47, 60.07, 49.95, 78.54, 26.58, 56.28, 60.73, 83.47,
    77.2, 47.99, 75.37, 35.44, 75.77, 35.06, 88.75,
]
RECOVERY = [None, None, 65, 63, 66, 62, 83, 96, 82, 95, 31, 54, 84, 64, 51, 86, 84, 42, 37, 28, 52]
CTL = [
    0.0, 0.0, 1.4, 2.3, 3.8, 5.0, 6.6, 7.8, 8.8, 10.4, 10.8, 11.9, 13.0, 14.7, 16.2, 16.9, 18.3,
    18.7, 20.0, 20.4, 22.0,
]
ATL = [
    0.0, 0.0, 7.8, 12.2, 19.6, 23.9, 30.3, 34.3, 36.4, 42.0, 39.9, 42.1, 44.6, 49.8, 53.4, 52.7,
    55.7, 53.0, 56.0, 53.2, 58.0,
]
CTL_DELTA = [None] * 7 + [7.8, 8.8, 9.0, 8.5, 8.1, 8.0, 8.1, 8.4, 8.1, 7.9, 7.9, 8.1, 7.4, 7.3]
MONOTONY = [
    None, 0.71, 0.58, 0.84, 1.04, 1.23, 1.38, 2.05, 5.25, 4.43, 3.33, 3.34, 3.44, 3.16, 3.09, 3.05,
    3.09, 3.59, 3.67, 2.91, 2.81,
]
FORM = ["neutral"] * 4 + ["fatigued"] * 5 + ["overtrained", "fatigued"] + ["overtrained"] * 10
PHASE = ["maintaining"] * 7 + ["building"] * 14
# week_start, days, load, average, ctl, atl, tsb, recovery, monotony, hard, easy, changes, spike
WEEKS = [
    ("2026-06-15", 1, 0.0, 0.0, 0.0, 0.0, 0.0, None, None, 0, 1, None, None, False),
    ("2026-06-22", 6, 291.2, 48.5, 6.6, 30.3, -23.7, 67.8, 0.96, 4, 1, 6.6, 291.2, True),
    ("2026-06-29", 7, 415.6, 59.4, 14.7, 49.8, -35.1, 72.3, 3.57, 6, 0, 8.1, 124.4, True),
    ("2026-07-06", 7, 435.6, 62.2, 22.0, 58.0, -36.0, 54.3, 3.17, 5, 0, 7.3, 20.0, True),
]


@pytest.fixture(scope="module")
def published(spark):
    days = [FIRST] + [SECOND + timedelta(i) for i in range(len(STRAIN) - 1)]
    records = [(1, day, s, r and float(r), None, None) for day, s, r in zip(days, STRAIN, RECOVERY)]
    schema = (
        "user_id long, cycle_date date, strain_score double, recovery_score double,"
        " hrv_rmssd_milli double, resting_heart_rate double"
    )
    return spark.createDataFrame(records, schema)


def test_published_daily_load(published):
    got = int_training_load(published).orderBy("cycle_date").collect()
    for name, expected in {
        "daily_tss": TSS,
        "ctl": CTL,
        "atl": ATL,
        "ctl_7d_delta": CTL_DELTA,
        "training_monotony_7d": MONOTONY,
        "form_label": FORM,
        "fitness_phase": PHASE,
        "tsb": [round(c - a, 1) for c, a in zip(CTL, ATL)],
    }.items():
        assert [row[name] for row in got] == expected, name


def test_published_weeks(spark, published):
    runs = spark.createDataFrame(
        [(date(2026, 6, 16), 10.5, 60.0, 6.0, 150.0), (date(2026, 6, 21), 6.01, 58.8, 8.0, None),
         (date(2026, 6, 24), 25.98, 143.1, 5.5, 152.0), (date(2027, 1, 4), 1.0, 1.0, 1.0, 1.0), (None, 9.0, 9.0, 9.0, 9.0)],
        "run_date date, distance_km double, moving_time_min double, pace_min_per_km double, run_avg_hr double",
    )
    got = fct_weekly_training_summary(int_training_load(published), runs).orderBy("week_start").collect()
    assert [
        (str(r.week_start), r.tracked_days, r.total_weekly_tss, r.avg_daily_tss, r.week_end_ctl, r.week_end_atl,
         r.week_end_tsb, r.avg_recovery, r.avg_monotony, r.hard_days, r.easy_or_rest_days, r.ctl_wow_delta,
         r.tss_wow_delta, r.load_spike_flag)
        for r in got
    ] == WEEKS
    assert [str(r.week_end) for r in got][:1] == ["2026-06-21"]
    assert [(r.run_count, r.total_distance_km, r.total_run_minutes, r.avg_pace_min_per_km, r.avg_run_hr) for r in got] == [
        (2, 16.51, 118.8, 7.0, 150.0), (1, 25.98, 143.1, 5.5, 152.0), (0, None, None, None, None), (0, None, None, None, None),
    ]
    assert [r.distance_wow_delta_km for r in got] == [16.51, 9.47, -25.98, 0.0]
    assert [r.week_end_form for r in got] == ["neutral", "fatigued", "overtrained", "overtrained"]


def test_weeks_of_two_users(spark, published):
    load = int_training_load(published.unionByName(published.withColumn("user_id", F.lit(2).cast("long"))))
    runs = spark.createDataFrame(
        [(1, date(2026, 6, 16), 10.0, 60.0, 6.0, 150.0)],
        "user_id long, run_date date, distance_km double, moving_time_min double, pace_min_per_km double, run_avg_hr double",
    )
    week = F.col("week_start") == "2026-06-15"
    alone = fct_weekly_training_summary(load, runs).where(week)
    assert rows(alone.select("user_id", "run_count")) == [(1, 1), (2, 1)]
    keyed = fct_weekly_training_summary(load, runs, "user_id").where(week)
    assert rows(keyed.select("user_id", "run_count")) == [(1, 1), (2, 0)]


def ewma_load_by_join(df, taus, cap):
    """The load as a self join: the other form, to check the window against."""
    past = df.select(F.col("user_id").alias("u"), F.col("cycle_date").alias("d"), F.col("x").alias("past"))
    age = F.datediff("cycle_date", "d")
    near = (F.col("u") == F.col("user_id")) & (F.col("d") <= F.col("cycle_date")) & (age <= cap)
    sums = [
        F.sum(F.col("past") * F.lit(1 - math.exp(-1 / t)) * F.exp(-age / F.lit(float(t)))).alias(name)
        for name, t in taus.items()
    ]
    return df.join(past, near, "left").groupBy("user_id", "cycle_date", "x").agg(*sums)


def test_window_load_equals_self_join(spark):
    rng = random.Random(7)
    start = date(1969, 6, 1)
    records = [
        (user, start + timedelta(d), None if rng.random() < 0.05 else rng.random() * 100)
        for user in range(6)
        for d in range(900)
        if rng.random() < 0.5
    ] + [(None, start, 5.0), (77, start, None)]
    df = spark.createDataFrame(records, "user_id long, cycle_date date, x double").repartition(5)
    taus, cap = {"ctl": 42.0, "atl": 7.0}, 180
    ours = rows(ewma_load(df, "x", taus=taus, cap=cap, digits=None), "user_id", "cycle_date")
    theirs = rows(ewma_load_by_join(df, taus, cap), "user_id", "cycle_date")
    assert len(ours) == len(theirs) == len(records)
    for a, b in zip(ours, theirs):
        assert a[:3] == b[:3]
        assert [x is None for x in a] == [x is None for x in b]
        assert [x or 0.0 for x in a[3:]] == pytest.approx([x or 0.0 for x in b[3:]], rel=1e-12, abs=1e-12), a


def test_lookback_ends_after_180_days(spark):
    day = date(2024, 1, 1)
    df = spark.createDataFrame(
        [(1, day, 1e6), (1, day + timedelta(180), 0.0), (1, day + timedelta(181), 0.0)],
        "user_id long, cycle_date date, x double",
    )
    got = [r[3] for r in rows(ewma_load(df, "x", taus={"ctl": 42.0}, digits=None), "cycle_date")]
    assert got[1] == pytest.approx(1e6 * (1 - math.exp(-1 / 42)) * math.exp(-180 / 42))
    assert got[2] == 0.0
    with pytest.raises(ValueError):
        ewma_load(df, "x", taus={"tiny": 0.1})


def load_input(spark, *records):
    schema = "user_id long, cycle_date date, strain_score double"
    df = spark.createDataFrame(records, schema)
    return df.withColumns({c: F.lit(None).cast("double") for c in ("recovery_score", "hrv_rmssd_milli", "resting_heart_rate")})


def test_monotony_of_one_and_of_equal_days(spark):
    day = date(2024, 1, 1)
    df = load_input(spark, (1, day, 5.0), *[(2, day + timedelta(i), 7.3) for i in range(7)])
    got = rows(int_training_load(df).select("user_id", "cycle_date", "training_monotony_7d"))
    assert {r[2] for r in got} == {None}


def test_two_rows_of_one_day(spark):
    day = date(2024, 1, 1)
    df = load_input(spark, (1, day, 21.0), (1, day, 10.5), (2, day, 21.0), (2, day, 21.0))
    with pytest.raises(PySparkException):
        int_training_load(df).collect()
    got = rows(int_training_load(df, unique_days=False).select("user_id", "daily_tss", "ctl"))
    one = round((100 + 50) * (1 - math.exp(-1 / 42)), 1)
    twice = round(2 * 200 * (1 - math.exp(-1 / 42)), 1)
    assert got == [(1, 50.0, one), (1, 100.0, one), (2, 100.0, twice)]


def test_missing_strain_and_date(spark):
    got = int_training_load(load_input(spark, (1, date(2024, 1, 1), None), (1, None, 5.0))).collect()
    assert [(r.daily_tss, r.strain_score, r.form_label) for r in got] == [(0.0, None, "neutral")]


def test_labels(spark):
    df = spark.createDataFrame([(67.0, 85.0), (66.9, 70.0), (34.0, 50.0), (33.9, 49.0), (None, None)], "r double, s double")
    got = df.select(labels.recovery_bucket("r"), labels.sleep_label("s")).collect()
    assert [r[0] for r in got] == ["peak", "optimal", "optimal", "poor", None]
    assert [r[1] for r in got] == ["excellent", "good", "fair", "poor", None]
    loads = spark.createDataFrame(
        [(26.0, 0.0), (25.0, 0.0), (5.0, 0.0), (0.0, 10.0), (0.0, 30.0), (0.0, 31.0), (None, 1.0), (10.0, 15.0), (10.0, 15.1)],
        "c double, a double",
    )
    got = loads.select(labels.form_label("c", "a"), labels.load_spike("c", "a")).collect()
    assert [r[0] for r in got] == [
        "very_fresh", "peak_form", "neutral", "neutral", "fatigued", "overtrained", "overtrained", "neutral", "neutral",
    ]
    assert [r[1] for r in got] == [False] * 8 + [True]


SLEEP_COLUMNS = """sleep_start sleep_end awake_hours light_sleep_hours sws_hours rem_hours sleep_cycle_count
disturbance_count sleep_needed_baseline_hours respiratory_rate sleep_consistency_pct
sleep_efficiency_pct score_state""".split()


def daily_input(spark):
    now = datetime(2024, 6, 1)
    cycles = spark.createDataFrame(
        [(i, 9, date(2024, 6, i), now, now, "SCORED", 10.0, 1.0, 60, 170, now) for i in (1, 2, 3, 4)],
        "cycle_id long, user_id long, cycle_date date, cycle_start timestamp, cycle_end timestamp, score_state string,"
        " strain_score double, kilojoule double, avg_heart_rate long, max_heart_rate long, loaded_at timestamp",
    )
    recoveries = spark.createDataFrame(
        [(1, 78.0, 52.0, 62.5, 98.0, 34.1, False, "SCORED"), (9, 1.0, 1.0, 1.0, 1.0, 1.0, True, "SCORED")],
        "cycle_id long, recovery_score double, resting_heart_rate double, hrv_rmssd_milli double, spo2_pct double,"
        " skin_temp_celsius double, is_calibrating boolean, score_state string",
    )
    sleeps = spark.createDataFrame(
        [("short", 1, False, 4.0, 0.333, 90.0), ("long", 1, False, 8.0, 0.333, 85.0), ("nap", 1, True, 9.0, None, 10.0),
         ("unknown", 2, None, 8.0, None, 50.0), ("none", 3, False, None, None, None), ("some", 3, False, 0.5, None, 60.0),
         ("lost", None, False, 8.0, None, 1.0)],
        "sleep_id string, cycle_id long, is_nap boolean, in_bed_hours double, awake_hours double, sleep_performance_pct double",
    )
    missing = [c for c in SLEEP_COLUMNS if c not in sleeps.columns]
    return cycles, recoveries, sleeps.withColumns({c: F.lit(None).cast("double") for c in missing})


def test_daily_metrics(spark):
    got = {r.cycle_id: r for r in int_daily_metrics(*daily_input(spark)).collect()}
    assert sorted(got) == [1, 2, 3, 4]
    assert (got[1].sleep_id, got[1].total_sleep_hours, got[1].sleep_quality_label) == ("long", 7.67, "excellent")
    assert (got[1].recovery_score, got[1].recovery_bucket) == (78.0, "peak")
    assert got[2].sleep_id is None and got[2].recovery_bucket is None
    assert (got[3].sleep_id, got[3].total_sleep_hours, got[3].sleep_quality_label) == ("some", 0.5, "fair")
    assert got[4].strain_score == 10.0 and got[4].sleep_id is None


def test_rolling_frames_count_rows(spark):
    day = date(2024, 1, 1)
    df = spark.createDataFrame(
        [(1, day + timedelta(i * 10), None if i == 3 else float(i)) for i in range(9)], "user_id long, cycle_date date, x double"
    )
    w = rolling.by_day()
    got = rows(
        df.select("cycle_date", rolling.rolling_avg("x", w, 7, 2), rolling.delta_prev("x", w), rolling.delta_prev("x", w, 1, True)),
        "cycle_date",
    )
    assert [r[1] for r in got] == [0.0, 0.5, 1.0, 1.0, 1.75, 2.4, 3.0, 4.17, 5.33]
    assert [r[2] for r in got] == [None, 1.0, 1.0, None, None, 1.0, 1.0, 1.0, 1.0]
    assert [r[3] for r in got] == [0.0, 1.0, 1.0, -2.0, 4.0, 1.0, 1.0, 1.0, 1.0]


def test_trends_and_users(spark):
    daily = int_daily_metrics(*daily_input(spark))
    trends = marts.my_trends(daily).orderBy("cycle_date").collect()
    assert len(trends) == 4 and len(trends[0]) == 25
    assert [r.strain_score_7d_avg for r in trends] == [10.0] * 4
    assert [r.strain_score_dod for r in trends] == [None, 0.0, 0.0, 0.0]
    users = spark.createDataFrame([(9, "A", "B", "a@example.org")], "user_id long, first_name string, last_name string, email string")
    now = datetime(2024, 6, 2)
    got = marts.dim_user(daily, users, now).collect()
    assert [(r.user_id, r.total_tracked_days, r.avg_recovery_score, r.avg_sleep_hours, r.email, r.dbt_updated_at) for r in got] == [
        (9, 1, 78.0, 7.67, "a@example.org", now)
    ]


def test_the_last_day_of_a_week_keeps_its_null(spark):
    columns = "user_id int, cycle_date date, fitness_phase string, form_label string, " + ", ".join(
        f"{c} double" for c in "daily_tss strain_score ctl atl tsb recovery_score hrv_rmssd_milli resting_heart_rate training_monotony_7d".split()
    )
    days = [(u, date(2027, 1, 4 + i), phase, "f", *[1.0] * 9) for u, i, phase in [(1, 0, "a"), (1, 1, None), (2, 0, "b")]]
    weeks = aggregates.weekly_load(spark.createDataFrame(days, columns))
    assert rows(weeks.select("user_id", "fitness_phase", "tracked_days")) == [(1, None, 2), (2, "b", 1)]


def test_period_counts(spark):
    df = spark.createDataFrame([(date(2026, 12, 28),), (date(2027, 1, 3),), (date(2027, 1, 4),), (None,)], "run_date date")
    assert [tuple(r) for r in aggregates.period_counts(df, "week").collect()] == [("2027-W01", 1), ("2026-W53", 2)]
    assert [tuple(r) for r in aggregates.period_counts(df, "year").collect()] == [("2027", 2), ("2026", 1)]
