"""Routes and periods, with and without slicing, against plain Python."""

import math
import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from paceforge.functions.geo import haversine_m
from paceforge.operators import periods, routes, running
from tests.conftest import rows

SAMPLE = "_p~iF~ps|U_ulLnnqC_mqNvxq`@"
SAMPLE_POINTS = [(38.5, -120.2), (40.7, -120.95), (43.252, -126.453)]


def metres(a, b):
    p, q = math.radians(a[0]), math.radians(b[0])
    h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
    return 2 * 6371000 * math.atan2(math.sqrt(h), math.sqrt(1 - h))


def test_decode(spark):
    lines = {
        1: SAMPLE,
        2: None,
        3: "",
        4: SAMPLE[:-1],
        5: "_p~iF~ps|U",
        6: SAMPLE + "?",
        7: "_p~iF~ps|U??",
        8: "_p~iF~ps|é",
        9: "~" * 20 + "?" + "?",
    }
    runs = spark.createDataFrame(list(lines.items()), "run_id long, summary_polyline string")
    points = routes.route_points(runs.repartition(2))
    assert rows(points) == [
        (run, i, *point)
        for run, found in {1: SAMPLE_POINTS, 5: SAMPLE_POINTS[:1], 7: SAMPLE_POINTS[:1] * 2}.items()
        for i, point in enumerate(found)
    ]
    assert tuple(routes.decode_failures(routes.decoded_routes(runs)).first()) == (3, 4)


def test_decode_of_no_lines(spark):
    runs = spark.createDataFrame([(1, None)], "run_id long, summary_polyline string")
    assert routes.route_points(runs).collect() == []


def test_haversine(spark):
    df = spark.createDataFrame([(*SAMPLE_POINTS[0], *SAMPLE_POINTS[1]), (0.0, 0.0, 0.0, 180.0), (1.0, 2.0, 1.0, 2.0)], "a double, b double, c double, d double")
    got = [r[0] for r in df.select(haversine_m("a", "b", "c", "d")).collect()]
    assert got == pytest.approx([metres(*SAMPLE_POINTS[:2]), math.pi * 6371000, 0.0])


def made_routes(seed=3):
    rng = random.Random(seed)
    made = {0: [(1.0, 1.0)], 1: [(2.0, 2.0)] * 3}
    for run in range(2, 8):
        place, points = (10.0, 20.0), []
        for _ in range(rng.randrange(2, 120)):
            if rng.random() < 0.8:
                place = (place[0] + rng.random() / 100, place[1] - rng.random() / 100)
            points.append(place)
        made[run] = points
    return made


def position(points, p):
    """Place at a fraction, by searching the distances."""
    dists = [0.0]
    for a, b in zip(points, points[1:]):
        dists.append(dists[-1] + metres(a, b))
    if p <= 0:
        return points[0]
    if p >= 1:
        return points[-1]
    target = p * dists[-1]
    low = max(i for i in range(max(len(points) - 1, 1)) if dists[i] <= target)
    high = min(low + 1, len(points) - 1)
    length = dists[high] - dists[low]
    t = (target - dists[low]) / length if length else 0.0
    return tuple(x + t * (y - x) for x, y in zip(points[low], points[high]))


@pytest.mark.parametrize("slices", [1, 9])
def test_distances_and_positions(spark, slices):
    made = made_routes()
    points = spark.createDataFrame(
        [(run, i, *point) for run, found in made.items() for i, point in enumerate(found)],
        "run_id long, point_idx int, lat double, lng double",
    ).repartition(4)
    measured = routes.cumulative_distance(points, slices=slices).cache()
    for run, _, distance, total in rows(
        measured.where("point_idx = 0").select("run_id", "point_idx", "distance_m", "route_m")
    ):
        length = sum(metres(a, b) for a, b in zip(made[run], made[run][1:]))
        assert distance == 0.0 and total == pytest.approx(length, abs=1e-6)
    links = {(r.run_id, r.point_idx): r for r in measured.collect()}
    for (run, i), row in links.items():
        if i:
            assert row.begun_m == links[run, i - 1].distance_m
            assert tuple(row.previous) == made[run][i - 1]
    fractions = [-1.0, 0.0, 0.1, 1 / 3, 0.5, 0.9, 0.9999999999999999, 1.0, 2.0]
    got = rows(routes.position_at(measured, fractions), "run_id", "p")
    assert [r[:2] for r in got] == [(run, p) for run in made for p in fractions]
    for run, p, lat, lng in got:
        assert (lat, lng) == pytest.approx(position(made[run], p), abs=1e-9), (run, p)


def test_measured_lines_equal_measured_points(spark):
    lines = {1: SAMPLE, 2: "_p~iF~ps|U", 3: SAMPLE[:-1], 4: SAMPLE + "????", 5: None}
    runs = spark.createDataFrame(list(lines.items()), "run_id long, summary_polyline string")
    fast = routes.measured_routes(runs).cache()
    slow = routes.cumulative_distance(routes.route_points(runs)).select(*fast.columns)
    a, b = rows(fast, "run_id", "point_idx"), rows(slow, "run_id", "point_idx")
    assert len(a) == len(b) == 9
    for x, y in zip(a, b):
        assert (x[:5], x[9]) == (y[:5], y[9])
        assert x[5:9] == pytest.approx(y[5:9], abs=1e-6)
    fractions = [0.0, 0.3, 0.5, 0.99999, 1.0]
    for run, p, lat, lng in rows(routes.position_at(fast, fractions)):
        found = SAMPLE_POINTS[:1] if run == 2 else SAMPLE_POINTS + SAMPLE_POINTS[-1:] * 2 * (run == 4)
        assert (lat, lng) == pytest.approx(position(found, p), abs=1e-9)
    decoded = routes.decoded_routes(runs)
    assert rows(routes.summarize_decoded(decoded)) == rows(routes.route_summary(routes.points_of(decoded)))


def test_summary_bounds_and_centroid(spark):
    made = made_routes()
    points = spark.createDataFrame(
        [(run, i, *point) for run, found in made.items() for i, point in enumerate(found)],
        "run_id long, point_idx int, lat double, lng double",
    )
    for row in routes.route_summary(points).collect():
        found = made[row.run_id]
        lats, lngs = [p[0] for p in found], [p[1] for p in found]
        middle = found[len(found) // 2]
        assert tuple(row)[1:] == (
            len(found), *found[0], *middle, *found[-1], min(lats), min(lngs), max(lats), max(lngs)
        )
    every = [p for found in made.values() for p in found]
    decoded = points.groupBy("run_id").agg(F.collect_list("lat").alias("lats"), F.collect_list("lng").alias("lngs"))
    assert tuple(routes.bounds_of_routes(decoded).first()) == tuple(routes.bounds(points).first())
    assert tuple(routes.bounds(points).first()) == (
        min(p[0] for p in every), min(p[1] for p in every), max(p[0] for p in every), max(p[1] for p in every)
    )
    assert tuple(routes.centroid(points).first()) == pytest.approx([sum(c) / len(every) for c in zip(*every)])


def made_runs(spark):
    day = date(2024, 6, 1)
    return spark.createDataFrame(
        [(1, day, 5.0, 6.21, 30.0, "x"), (2, day, 9.0, None, 0.0, "x"), (3, day + timedelta(1), None, 7.5, None, "x"),
         (4, day + timedelta(2), 7.0, 9.0, 60.0, None), (5, day + timedelta(1), 5.0, 6.21, 10.0, "x"), (6, day, 1.0, 0.0, 5.0, "")],
        "run_id long, run_date date, distance_km double, speed_mph double, moving_time_min double, summary_polyline string",
    )


def test_highlights_and_sorts(spark):
    runs = made_runs(spark)
    assert {r.highlight: r.run_id for r in periods.highlights(runs).collect()} == {"longest": 1, "fastest": 3, "latest": 3}
    assert periods.highlights(runs.where("false")).collect() == []
    named = periods.highlights(runs.withColumn("run_id", F.concat(F.lit("r"), F.col("run_id").cast("string"))))
    assert [r.run_id for r in named.collect()] == [f"r{r.run_id}" for r in periods.highlights(runs).collect()]
    assert [r.run_id for r in periods.newest(runs, 2).collect()] == [4, 5]
    assert [r.run_id for r in periods.mapped_runs(runs).collect()] == [5, 3, 2, 1]
    assert [r.run_id for r in periods.mapped_runs(runs, 1).collect()] == [5]
    assert [r.run_id for r in periods.sorted_runs(runs, "dist").collect()] == [2, 4, 1, 5, 6, 3]
    assert [r.run_id for r in periods.sorted_runs(runs, "speed", desc=False).collect()] == [2, 6, 1, 5, 3, 4]
    assert [r.run_id for r in periods.sorted_runs(runs).collect()] == [4, 3, 5, 1, 2, 6]
    assert rows(periods.runs_in_period(runs, "day", "2024-06-02").select("run_id")) == [(3,), (5,)]


def test_speed_scale(spark):
    runs = made_runs(spark)
    assert tuple(periods.speed_range(runs).first()) == (6.21, 9.0)
    assert tuple(periods.speed_range(runs.where("speed_mph is null")).first()) == (5.0, 10.0)
    got = dict(rows(periods.speed_scale(runs).select("run_id", "speed_position"), "run_id"))
    assert got[1] == 0.0 and got[4] == 1.0 and got[2] is None and got[6] == 0.0
    assert got[3] == pytest.approx((7.5 - 6.21) / (9.0 - 6.21))
    same = runs.where("run_id in (1, 5)")
    assert {r.speed_position for r in periods.speed_scale(same).collect()} == {0.0}


@pytest.mark.parametrize("slices", [1, 30])
def test_period_slots(spark, slices):
    rng = random.Random(5)
    start = date(2024, 1, 1)
    # Two thirds of a year's runs fall on one day.
    runs = [(i, "hot" if i % 3 else "rest", start + timedelta(0 if i % 3 == 1 else rng.randrange(200)), rng.choice([None, 0.0, 5.0, 30.0])) for i in range(300)]
    df = spark.createDataFrame(runs, "run_id long, g string, run_date date, moving_time_min double").repartition(3)
    got = {r.run_id: (r.slot_start, r.slot_end) for r in periods.period_slots(df, ["g"], slices=slices).collect()}
    for group in ("hot", "rest"):
        done, members = 0.0, sorted((d, i, m or 1.0) for i, g, d, m in runs if g == group)
        total = sum(m for _, _, m in members)
        for _, i, minutes in members:
            assert got[i] == pytest.approx((done / total, (done + minutes) / total))
            done += minutes


def test_tracks_by_time(spark):
    start = datetime(2024, 6, 1)
    points = [(1, start + timedelta(seconds=i // 3), i, 10 + (i * 7 % 50) / 1000, 20.0) for i in range(90)]
    df = spark.createDataFrame(points, "user_id long, ts timestamp, event_id long, lat double, lng double").repartition(5)
    sums = [0.0]
    for a, b in zip(points, points[1:]):
        sums.append(sums[-1] + metres(a[3:], b[3:]))
    for slices in (1, 4, 40):
        measured = routes.cumulative_distance(df, ["user_id"], ["ts", "event_id"], slices)
        assert [r[1] for r in rows(measured.select("event_id", "distance_m"))] == pytest.approx(sums)


def encoded(points):
    """A line of points in whole 1e-5 degrees."""
    text, before = "", (0, 0)
    for point in points:
        for now, last in zip(point, before):
            step = now - last
            number = ~(step << 1) if step < 0 else step << 1
            while number >= 32:
                text += chr((number & 31 | 32) + 63)
                number >>= 5
            text += chr(number + 63)
        before = point
    return text


def test_a_line_does_not_depend_on_its_neighbours(spark):
    good = [(4000000, -7000000), (4000100, -7000300), (4010000, -6990000)]
    far = [(1234, 0), (-1234, 18000000)] * 200
    lines = {1: good, 2: far, 3: good, 4: [(1234, 0), (-1234, 18000000)], 5: good}
    runs = spark.createDataFrame([(k, encoded(v)) for k, v in lines.items()], "run_id long, summary_polyline string").coalesce(1)
    together = {(r.run_id, r.point_idx): (r.segment_m, r.distance_m, r.route_m) for r in routes.measured_routes(runs).collect()}
    for k in lines:
        alone = routes.measured_routes(runs.where(F.col("run_id") == k)).collect()
        assert [together[k, r.point_idx] for r in alone] == [(r.segment_m, r.distance_m, r.route_m) for r in alone]
        assert len(alone) == len(lines[k]) and all(r.distance_m == r.distance_m for r in alone)


def test_one_hot_key_is_bit_equal_at_any_cut_and_partitioning(spark):
    rng = random.Random(2)
    start = date(2024, 1, 1)
    # sparse ids, a third of all rows in one group, most of them on one day
    runs = [(i * 100_003, "hot" if i % 3 == 0 else f"g{i % 40}", start + timedelta(rng.choice([3, 3, 3, rng.randrange(30)])), rng.random() * 90) for i in range(3000)]
    df = spark.createDataFrame(runs, "run_id long, g string, run_date date, moving_time_min double")
    found = set()
    for slices, parts in ((1, 1), (10, 7), (200, 13)):
        found.add(tuple(rows(periods.period_slots(df.repartition(parts), ["g"], slices=slices).select("run_id", "slot_start", "slot_end"))))
    assert len(found) == 1


def test_slices_follow_the_rows(spark):
    """A group with a third of the rows, sparse ids, all in one hour: no slice holds twice the mean."""
    df = spark.range(30_000).selectExpr("id * 100003 as event_id", "if(id % 3 = 0, 'hot', concat('g', id % 500)) as g", "timestamp'2024-06-01' + make_dt_interval(0, 0, 0, id % 3600) as ts", "1 as v")
    cut = running.sliced(df, ["g"], ["ts", "event_id"], 16)
    sizes = [r["count"] for r in cut.groupBy(running.SLICE).count().collect()]
    assert len(sizes) == 16 and sum(sizes) == 30_000 and max(sizes) <= 2 * 30_000 / 16
    summed = running.running_sum(cut, ["g"], ["ts", "event_id"], "v", "before", "after", "total", "is_last")
    plan = summed._jdf.queryExecution().executedPlan().toString()
    # rows are shuffled once, by slice; all other exchanges have partial sums below them
    lines = plan.split("\n")
    exchanges = [(line, lines[i + 1]) for i, line in enumerate(lines) if "Exchange" in line and "Broadcast" not in line]
    assert sum("shufflepartitionidpassthrough" in line for line, _ in exchanges) == 1
    assert all("Aggregate" in below for line, below in exchanges if "hashpartitioning(__slice" in line)
    got = summed.groupBy("g").agg(F.max("after").alias("most"), F.min("before").alias("least"), F.max("total").alias("total"), F.count("v").alias("n"), F.count_if("is_last").alias("ends"), F.countDistinct("after").alias("steps")).collect()
    assert all((r.most, r.least, r.total, r.ends, r.steps) == (r.n, 0, r.n, 1, r.n) for r in got)


@pytest.mark.parametrize("slices", [1, 13])
def test_positions(spark, slices):
    rng = random.Random(3)
    values = [(i, rng.choice([None, 1.0, 2.0, 2.0, 7.5])) for i in range(500)]
    df = spark.createDataFrame(values, "k long, x double").repartition(6)
    got = running.positions(df, [F.desc_nulls_last("x"), F.asc("k")], slices=slices)
    want = sorted(values, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    assert [r[0] for r in sorted(got.collect(), key=lambda r: r.position)] == [r[0] for r in want]
    assert sorted(r.position for r in got.collect()) == list(range(1, 501))
    assert running.positions(df.limit(0), [F.asc("k")]).collect() == []
    ordered = running.as_ordered(df.orderBy(F.desc("k")))
    assert ordered.columns == ["k", "x", "position"] and all(r.k + r.position == 500 for r in ordered.collect())
