"""Training load that is kept from build to build."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from paceforge.operators import upsert
from paceforge.plans import carried
from paceforge.plans.carried import read_load, refresh_load
from paceforge.plans.load import int_training_load
from paceforge.storage import folders
from tests.conftest import rows

SCHEMA = "user_id long, cycle_date date, strain_score double, recovery_score double, hrv_rmssd_milli double, resting_heart_rate double, note string"


def days_of(seed, users=12, first=date(2019, 1, 1)):
    """Days of users, dense for some and weeks or months apart for others."""
    r = random.Random(seed)
    found = {}
    for user in range(users):
        day = first + timedelta(r.randint(0, 40))
        while day < date(2022, 6, 1):
            found[user, day] = (user if user else None, day, round(r.uniform(0, 21), 3), None, 40.0, None, "x")
            day += timedelta(1 if user % 3 == 0 else r.randint(1, 3) if user % 3 == 1 else r.randint(20, 150))
    return found


def frame(spark, days):
    return spark.createDataFrame(sorted(days.values(), key=str), SCHEMA)


def equal(spark, table, daily):
    assert rows(read_load(spark, table)) == rows(int_training_load(daily))


def test_refresh_equals_a_full_build(spark, database):
    table = f"{database}.load"
    days = days_of(1)
    daily = frame(spark, days)
    first = refresh_load(daily, table)
    assert first["users"] == 12 and first["rows_read"] == len(days)
    equal(spark, table, daily)
    assert refresh_load(daily.withColumn("note", F.lit("y")), table) == {"users": 0, "rows_read": 0, "parts_written": 0}

    last = {user: max(d for u, d in days if u == user) for user in range(12)}
    nightly = days | {(u, last[u] + timedelta(1)): (u if u else None, last[u] + timedelta(1), 9.5, 1.0, None, None, "x") for u in range(12)}
    got = refresh_load(frame(spark, nightly), table)
    assert got["users"] == 12 and got["rows_read"] < 0.5 * len(days) and got["parts_written"] <= 3
    equal(spark, table, frame(spark, nightly))

    # a late change, a day that is gone, a user that is gone, a new user, a day before all others
    late = dict(nightly)
    late[3, date(2020, 5, 5)] = (3, date(2020, 5, 5), 20.0, None, None, None, "x")
    del late[2, last[2]]
    late = {k: v for k, v in late.items() if k[0] != 4} | {(99, date(2021, 1, 1)): (99, date(2021, 1, 1), 5.0, None, None, None, "x")}
    late[5, date(2018, 1, 1)] = (5, date(2018, 1, 1), 7.0, None, None, None, "x")
    got = refresh_load(frame(spark, late), table)
    assert got["users"] == 5 and got["rows_read"] < 0.5 * len(late)
    equal(spark, table, frame(spark, late))


def test_refresh_of_one_user_reads_no_other(spark, database):
    table = f"{database}.load"
    days = days_of(2, users=30)
    refresh_load(frame(spark, days), table)
    changed = days | {(7, date(2022, 6, 2)): (7, date(2022, 6, 2), 3.0, None, None, None, "x")}
    before = {p for p in folders(spark, upsert._home(spark, table))}
    got = refresh_load(frame(spark, changed), table)
    own = sum(u == 7 for u, _ in changed)
    assert got["users"] == 1 and got["rows_read"] <= own and got["parts_written"] <= 2
    assert before <= set(folders(spark, upsert._home(spark, table)))  # parts without a change stay where they are
    equal(spark, table, frame(spark, changed))


@pytest.mark.parametrize("step", ["_written", "_registered", "_show"])
def test_a_stop_leaves_the_mart_readable(spark, database, monkeypatch, step):
    table = f"{database}.load"
    days = days_of(3, users=4)
    daily = frame(spark, days)
    refresh_load(daily, table)
    changed = frame(spark, days | {(1, date(2022, 6, 5)): (1, date(2022, 6, 5), 3.0, None, None, None, "x")})

    def stop(*args, **kwargs):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(carried, step, stop)
        with pytest.raises(RuntimeError):
            refresh_load(changed, table)
    equal(spark, table, daily)
    refresh_load(changed, table)
    equal(spark, table, changed)


def test_awkward_input(spark, database):
    table = f"{database}.load"
    empty = spark.createDataFrame([], SCHEMA)
    assert refresh_load(empty, table)["users"] == 0 and read_load(spark, table).count() == 0
    daily = spark.createDataFrame([(1, None, 5.0, None, None, None, "x"), (None, date(1969, 7, 1), None, None, None, None, "x"), (2, date(2024, 1, 1), None, None, None, None, "x")], SCHEMA)
    assert refresh_load(daily, table)["users"] == 2
    equal(spark, table, daily)
    assert refresh_load(empty, table)["users"] == 2 and read_load(spark, table).count() == 0
    spark.range(1).write.saveAsTable(f"{database}.other")
    with pytest.raises(ValueError):
        refresh_load(daily, f"{database}.other")


def test_two_rows_of_one_day(spark, database):
    table = f"{database}.load"
    day = date(2024, 1, 1)
    twice = spark.createDataFrame([(1, day, 5.0, None, None, None, "x")] * 2 + [(1, day, 6.0, None, None, None, "x")], SCHEMA)
    refresh_load(twice.limit(1), table, unique_days=False)
    refresh_load(twice, table, unique_days=False)
    assert rows(read_load(spark, table)) == rows(int_training_load(twice, unique_days=False))
