"""Landed JSON records against the raw tables."""

import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from paceforge.sources import landing
from paceforge.sources.schemas import RAW_TABLES, landing_schema, raw_field, raw_schema

LOADED = datetime(2024, 6, 2, 6, tzinfo=timezone.utc)


def conform(spark, tmp_path, kind, *records):
    path = tmp_path / kind
    path.mkdir()
    (path / "part.json").write_text("\n".join(json.dumps(r) for r in records))
    landed = landing.read_landing(spark, kind, str(path))
    if kind == "runs":
        landed = landing.only_runs(landed)
    return landing.CONFORM[kind](landed, LOADED).orderBy(F.col(landed.columns[0])).collect()


def test_raw_schemas(spark):
    assert len(RAW_TABLES) == 8
    assert raw_schema("raw_cycles")["id"].nullable is False
    assert raw_schema("raw_cycles")["score"].nullable is True
    assert raw_field("raw_sleeps", "score.stage_summary.disturbance_count").simpleString() == "bigint"
    assert len(raw_field("raw_workouts", "score.zone_duration")) == 6
    with pytest.raises(KeyError):
        raw_schema("raw_unknown")
    with pytest.raises(KeyError):
        landing_schema("unknown")


def test_cycles(spark, tmp_path):
    full = {"strain": 9.25, "kilojoule": 6120.5, "average_heart_rate": 71, "max_heart_rate": 158}
    times = {"start": "2024-06-01T00:00:00Z", "end": "2024-06-01T21:40:30.000Z", "timezone_offset": "+02:00"}
    got = conform(
        spark,
        tmp_path,
        "cycles",
        {"id": 700, "user_id": 8811, "score_state": "SCORED", "score": full, **times},
        {"id": 701, "user_id": 1},
        {"id": 702, "user_id": 1, "score": {"strain": 10.0}},
        {"id": 703, "user_id": 1, "score": {}},
        {"id": 704, "user_id": 1, "score": None},
        {"id": 705, "user_id": 1, "score": {"strain": None}},
    )
    assert got[0].score.asDict() == full
    assert (got[0].user_id, got[0].timezone_offset, got[0].score_state) == (8811, "+02:00", "SCORED")
    assert got[0].start == datetime(2024, 6, 1) and got[0].end == datetime(2024, 6, 1, 21, 40, 30)
    assert got[0].loaded_at == datetime(2024, 6, 2, 6)
    assert [row.score is None for row in got] == [False, True, False, True, True, False]
    assert got[2].score.strain == 10.0 and got[2].score.kilojoule is None
    assert got[5].score.strain is None


def test_sleeps(spark, tmp_path):
    stage = {
        "total_in_bed_time_milli": 2788110000,
        "total_awake_time_milli": 1860000,
        "total_light_sleep_time_milli": 11100000,
        "sleep_cycle_count": 6,
    }
    score = {"stage_summary": stage, "sleep_needed": {"baseline_milli": 28260000}, "respiratory_rate": 13.7}
    got = conform(
        spark,
        tmp_path,
        "sleeps",
        {"id": 510, "cycle_id": 700, "user_id": 8811, "nap": False, "score": score},
        {"id": 511, "user_id": 1, "score": {"respiratory_rate": 14.0}},
        {"id": 512, "user_id": 1},
    )
    assert got[0].id == "510" and got[0].nap is False
    assert got[0].score.stage_summary.sleep_cycle_count == 6
    assert got[0].score.sleep_needed.baseline_milli == 28260000
    assert got[0].score.respiratory_rate == 13.7
    assert got[1].score.stage_summary is not None and got[1].score.sleep_needed is not None
    assert got[1].score.stage_summary.total_in_bed_time_milli is None
    assert got[2].score is None


def test_recoveries(spark, tmp_path):
    full = {
        "user_calibrating": False,
        "recovery_score": 66.0,
        "resting_heart_rate": 47.0,
        "hrv_rmssd_milli": 81.25,
        "spo2_percentage": 96.5,
        "skin_temp_celsius": 33.4,
    }
    got = conform(
        spark,
        tmp_path,
        "recoveries",
        {"cycle_id": 700, "sleep_id": 510, "user_id": 8811, "score": full},
        {"cycle_id": 701, "user_id": 8811, "score": {"user_calibrating": True, "recovery_score": None}},
    )
    assert got[0].score.asDict() == full and got[0].sleep_id == "510"
    assert got[1].score.user_calibrating is True and got[1].score.recovery_score is None


def test_workouts(spark, tmp_path):
    zones = dict(zip(("zone_zero_milli", "zone_one_milli", "zone_two_milli"), (95000, 410000, 733000)))
    got = conform(
        spark,
        tmp_path,
        "workouts",
        {"id": 880, "user_id": 8811, "sport_name": "running", "score": {"strain": 8.75, "zone_durations": zones}},
        {"id": 881, "user_id": 8811, "score": {"strain": 5.0}},
        {"id": 882, "user_id": 8811, "score": {"strain": 5.0, "zone_durations": {}, "zone_duration": zones}},
        {"id": 883, "user_id": 8811, "score": {"zone_durations": {"zone_zero_milli": 1}, "zone_duration": zones}},
        {"id": 884, "user_id": 8811},
    )
    assert got[0].score.strain == 8.75 and got[0].score.zone_duration.zone_two_milli == 733000
    assert got[0].score.zone_duration.zone_five_milli is None
    assert got[1].score.zone_duration is None
    assert got[2].score.zone_duration.zone_zero_milli == 95000
    assert got[3].score.zone_duration.zone_zero_milli == 1
    assert got[4].score is None


def test_runs(spark, tmp_path):
    full = {
        "id": 90417,
        "name": "Morning",
        "sport_type": "Run",
        "start_date": "2024-06-01T07:30:00Z",
        "distance": 11350.5,
        "moving_time": 3725,
        "elapsed_time": 3980,
        "total_elevation_gain": 85.5,
        "average_speed": 3.05,
        "max_speed": 5.6,
        "map": {"summary_polyline": "abc"},
    }
    kinds = ["Run", "Ride", "TrailRun", "Swim", "VirtualRun"]
    got = conform(
        spark, tmp_path, "runs", full, *[{"id": i + 1, "sport_type": kind} for i, kind in enumerate(kinds)]
    )
    assert [row.id for row in got] == [1, 3, 5, 90417]
    run = got[3]
    assert (run.distance_meter, run.moving_time_sec, run.elapsed_time_sec) == (11350.5, 3725, 3980)
    assert (run.average_speed_ms, run.max_speed_ms, run.total_elevation_gain_meter) == (3.05, 5.6, 85.5)
    assert run.summary_polyline == "abc" and run.suffer_score is None
    assert got[0].summary_polyline is None and got[0].distance_meter is None


def test_users(spark, tmp_path):
    got = conform(spark, tmp_path, "users", {"user_id": 1, "email": "a@example.org", "first_name": "A"})
    assert tuple(got[0]) == (1, "a@example.org", "A", None, datetime(2024, 6, 2, 6))


def test_photos(spark, tmp_path):
    got = conform(
        spark,
        tmp_path,
        "photos",
        {"id": 1, "photos": []},
        {"id": 2},
        {"id": 3, "photos": [{"urls": {}}, {"urls": {"600": ""}}, {"urls": {"600": "", "100": "small"}}]},
        {"id": 4, "photos": [{"urls": {"600": "big", "100": "small"}}, {"urls": {"600": "other"}}]},
        {"id": 5, "photos": [{"urls": None}]},
    )
    assert [(r.id, r.primary_photo_url, r.photo_count) for r in got] == [
        (1, None, 0),
        (2, None, 0),
        (3, "small", 3),
        (4, "big", 2),
        (5, None, 1),
    ]
