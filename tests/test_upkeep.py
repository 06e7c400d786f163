"""Upserts, raw tables, audited loads, quality checks, exports, streaming and the whole build."""

import json
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from paceforge.operators import quality
from paceforge.operators import upsert as upsert_module
from paceforge.operators.upsert import MONTH, merge_mart, read_mart, rescan_window, sync_columns, upsert
from paceforge.plans import marts, staging
from paceforge.sources import export, tables
from paceforge.sources.schemas import AUDIT_TABLE, RAW_TABLES, landing_schema
from paceforge.storage import folders
from paceforge.streaming import ingest, weeks
from paceforge.workloads import derive, queries
from tests.conftest import rows

DAY = date(2024, 6, 20)
NOW = datetime(2024, 7, 1, 6, tzinfo=timezone.utc)


def mart(spark, *records):
    return spark.createDataFrame(records, "id long, d date, v string")


def test_upsert_replaces_adds_and_keeps(spark):
    target = mart(spark, (1, DAY, "old"), (2, DAY, "kept"), (None, DAY, "no key"))
    source = mart(spark, (1, DAY, "new"), (3, DAY, "added"))
    assert rows(upsert(target, source, "id").select("id", "v")) == [(None, "no key"), (1, "new"), (2, "kept"), (3, "added")]


def test_rescan_window(spark):
    source = mart(spark, *[(i, DAY - timedelta(i), "new") for i in range(10)], (99, None, "undated"))
    target = mart(spark, *[(i, DAY - timedelta(i), "old") for i in range(10)])
    assert rows(rescan_window(source, target, "d").select("id")) == [(i,) for i in range(8)]
    assert rescan_window(source, target.where("false"), "d").count() == 0
    assert rescan_window(source, None, "d").count() == 11


def test_sync_columns(spark):
    target = spark.createDataFrame([(1, "gone")], "id long, old string")
    source = spark.createDataFrame([(2, 5.0)], "id long, fresh double")
    assert rows(sync_columns(target, source)) == [(1, None)]
    merged = upsert(target, source, "id")
    assert merged.columns == ["id", "fresh"] and rows(merged) == [(1, None), (2, 5.0)]


def test_merge_mart(spark, database):
    table = f"{database}.fact"
    first = mart(spark, *[(i, DAY - timedelta(i * 4), "old") for i in range(20)])
    merge_mart(first, table, "id", "d")
    assert read_mart(spark, table).count() == 20

    # Key 1 is in the window, key 2 is 8 days back, key 19 moves here from a month of its own.
    changed = [(0, DAY, "new"), (1, DAY - timedelta(4), "new"), (2, DAY - timedelta(8), "late"), (19, DAY, "moved"), (50, DAY + timedelta(15), "added")]
    alone = rows(spark.table(table).where("id = 19").select(MONTH))[0][0]
    assert spark.table(table).where(F.col(MONTH) == alone).count() == len([i for i in range(20) if f"{DAY - timedelta(i * 4):%Y-%m}" == alone])
    for _ in range(2):
        merge_mart(mart(spark, *changed), table, "id", "d")
        got = {i: (d, v) for i, d, v in rows(read_mart(spark, table))}
        assert len(got) == 21
        assert got[0][1] == "new" and got[1][1] == "new"
        assert got[2][1] == "old"
        assert got[19] == (DAY, "moved") and got[50][1] == "added"
        # The newest date has moved on, so a second run sees key 50 only.
        changed = changed[-1:]


def test_merge_empties_a_month(spark, database):
    table = f"{database}.fact"
    merge_mart(mart(spark, (1, date(2024, 1, 5), "alone"), (2, DAY, "x")), table, "id", "d")
    merge_mart(mart(spark, (1, DAY, "moved")), table, "id", "d")
    assert rows(read_mart(spark, table)) == [(1, DAY, "moved"), (2, DAY, "x")]
    assert rows(spark.table(table).select(MONTH).distinct()) == [("2024-06",)]


STEPS = ("stored", "_written", "_publish", "_registered", "_show")


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("columns", ["v", "w"])
def test_a_stop_at_any_step_leaves_a_readable_mart(spark, database, monkeypatch, step, after, columns):
    table = f"{database}.fact"
    old = [(1, date(2024, 6, 25), "old"), (2, date(2024, 6, 30), "old"), (3, date(2024, 1, 1), "old")]
    merge_mart(mart(spark, *old), table, "id", "d")
    new = [(1, date(2024, 6, 25), "new"), (2, date(2024, 7, 1), "new"), (3, date(2024, 6, 28), "new"), (4, date(2024, 7, 20), "new")]
    source = mart(spark, *new).withColumnRenamed("v", columns)
    whole = getattr(upsert_module, step)

    def stops(*args):
        if after:
            whole(*args)
        raise RuntimeError("lost")

    monkeypatch.setattr(upsert_module, step, stops)
    with pytest.raises(RuntimeError):
        merge_mart(source, table, "id", "d")
    monkeypatch.undo()
    done = after and step in ("_show", "_publish")
    assert rows(read_mart(spark, table)) == (new if done else old)
    if not done:
        merge_mart(source, table, "id", "d")
    assert rows(read_mart(spark, table)) == new and read_mart(spark, table).columns == ["id", "d", columns]
    assert rows(spark.table(table).select(MONTH).distinct()) == [("2024-06",), ("2024-07",)]
    # what the stopped merge has written is gone after the next one
    merge_mart(source, table, "id", "d")
    versions = [t.name for t in spark.catalog.listTables(database, pattern="fact__v_*")]
    assert len(versions) <= 2 and rows(read_mart(spark, table)) == new


def test_a_stopped_first_build_blocks_nothing(spark, database, monkeypatch):
    table = f"{database}.fact"
    for step in ("_registered", "_show"):
        monkeypatch.setattr(upsert_module, step, lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            merge_mart(mart(spark, (1, DAY, "a")), table, "id", "d")
        monkeypatch.undo()
        assert not spark.catalog.tableExists(table)
    merge_mart(mart(spark, (1, DAY, "a")), table, "id", "d")
    assert rows(read_mart(spark, table)) == [(1, DAY, "a")]


def test_a_merge_reads_and_writes_touched_months_and_index_parts(spark, database, monkeypatch):
    table = f"{database}.fact"
    first = mart(spark, *[(i, date(2024, 1 + i % 6, 20), "old") for i in range(60)])
    merge_mart(first, table, "id", "d")
    held = upsert_module._held(spark, table)
    months = upsert_module._places(spark, f"{table}__v_{held}", MONTH)
    parts = upsert_module._places(spark, f"{table}__k_{held}", upsert_module.BUCKET)
    read = []
    plain = upsert_module.upsert

    def watched(target, source, key):
        read.append(target.inputFiles())
        return plain(target, source, key)

    monkeypatch.setattr(upsert_module, "upsert", watched)
    merge_mart(mart(spark, (1, date(2024, 6, 20), "moved"), (7, date(2024, 2, 20), "new"), (None, DAY, "none")), table, "id", "d", days=None)
    monkeypatch.undo()
    held = upsert_module._held(spark, table)
    after = upsert_module._places(spark, f"{table}__v_{held}", MONTH)
    assert {m for m in after if after[m] != months[m]} == {"2024-02", "2024-06"}
    assert {f.split(f"{MONTH}=")[1][:7] for f in read[0]} == {"2024-02", "2024-06"}
    moved = upsert_module._places(spark, f"{table}__k_{held}", upsert_module.BUCKET)
    changed = {b for b in moved if moved[b] != parts.get(b)}
    assert len(changed) <= 2 and {f.split(f"{upsert_module.BUCKET}=")[1].split("/")[0] for f in read[1]} <= changed
    got = {r[0]: r[1:] for r in rows(read_mart(spark, table)) if r[0] is not None}
    assert len(got) == 60 and got[1] == (date(2024, 6, 20), "moved") and got[7][1] == "new"
    index = spark.table(f"{table}__k_{held}")
    assert rows(index.select("id", MONTH)) == rows(spark.table(table).where("id is not null").select("id", MONTH))


def test_merge_of_changed_columns(spark, database):
    table = f"{database}.fact"
    merge_mart(mart(spark, (1, DAY, "a"), (2, DAY - timedelta(30), "b")), table, "id", "d")
    source = spark.createDataFrame([(1, DAY, 1.5), (2, DAY - timedelta(30), 2.5)], "id long, d date, extra double")
    merge_mart(source, table, "id", "d")
    assert rows(read_mart(spark, table).select("id", "d", "extra")) == [(1, DAY, 1.5), (2, DAY - timedelta(30), None)]


def test_merge_into_an_empty_mart_takes_nothing(spark, database):
    table = f"{database}.fact"
    merge_mart(mart(spark, (1, DAY, "a")).where("false"), table, "id", "d")
    merge_mart(mart(spark, (1, DAY, "a")), table, "id", "d")
    assert read_mart(spark, table).count() == 0


def test_files_of_a_stopped_merge_block_nothing(spark, database, monkeypatch):
    table = f"{database}.fact"
    merge_mart(mart(spark, (1, DAY, "a")), table, "id", "d")
    plain = upsert_module.upsert

    def stops(*args):
        broken = plain(*args)
        return broken.withColumn("v", F.when(F.col("id") == 2, F.raise_error(F.lit("lost"))).otherwise(F.col("v")))

    monkeypatch.setattr(upsert_module, "upsert", stops)
    with pytest.raises(PySparkException):
        merge_mart(mart(spark, (2, DAY, "b")), table, "id", "d")
    monkeypatch.undo()
    merge_mart(mart(spark, (2, DAY, "b")), table, "id", "d")
    assert rows(read_mart(spark, table)) == [(1, DAY, "a"), (2, DAY, "b")]
    upsert_module.drop_mart(spark, table)
    assert [t.name for t in spark.catalog.listTables(database) if not t.isTemporary] == [] and folders(spark, upsert_module._home(spark, table)) == []


def test_repeated_keys_are_refused(spark, database):
    table = f"{database}.fact"
    twice = mart(spark, (1, DAY, "a"), (1, DAY, "b"), (None, DAY, "c"), (None, DAY, "d"))
    with pytest.raises(ValueError, match="id 1 is in the source more than once"):
        merge_mart(twice, table, "id", "d")
    merge_mart(twice.where("v <> 'b'"), table, "id", "d")
    with pytest.raises(ValueError):
        merge_mart(twice, table, "id", "d")
    merge_mart(mart(spark, (1, DAY, "e")), table, "id", "d")
    assert rows(read_mart(spark, table).where("id = 1")) == [(1, DAY, "e")]


def test_a_changed_type_is_followed(spark, database):
    table = f"{database}.fact"
    merge_mart(mart(spark, (1, DAY, "5"), (2, DAY - timedelta(40), "6")), table, "id", "d")
    merge_mart(spark.createDataFrame([(1, DAY, 7.5)], "id long, d date, v double"), table, "id", "d")
    assert dict(read_mart(spark, table).dtypes)["v"] == "double"
    assert rows(read_mart(spark, table)) == [(1, DAY, 7.5), (2, DAY - timedelta(40), 6.0)]


def test_late_rows_of_a_stream_are_merged(spark, database):
    table = f"{database}.fact"
    fact = lambda *r: spark.createDataFrame(r, "id long, d date, v string, loaded_at timestamp")
    early, late = datetime(2024, 6, 1), datetime(2024, 6, 2)
    merge_mart(fact((1, DAY, "a", late), (2, DAY, "newer", late)), table, "id", "d")
    merge_mart(fact((2, DAY, "older", early), (3, DAY - timedelta(30), "late", early)), table, "id", "d", days=None, version="loaded_at")
    assert rows(read_mart(spark, table).select("id", "v")) == [(1, "a"), (2, "newer"), (3, "late")]


def test_a_repeated_first_row_keeps_the_document_valid(spark):
    load = spark.createDataFrame([(DAY, 1, 2.5), (DAY, 1, 2.5), (DAY + timedelta(1), 1, 3.5)], "cycle_date date, user_id long, daily_tss double")
    columns = ["cycle_date", "user_id", "daily_tss"]
    lines = export.json_document(load, columns, [F.col("cycle_date"), F.col("user_id")], NOW, "row_count", "rows")
    found = json.loads("\n".join(r.value for r in lines.collect()))
    assert [r["daily_tss"] for r in found["rows"]] == [2.5, 2.5, 3.5] and found["row_count"] == 3
    parsed = export.parsed_document(lines, export.export_rows(load, columns).schema, "row_count")
    assert rows(parsed.select("daily_tss", "row_count")) == [(2.5, 3), (2.5, 3), (3.5, 3)]
    empty = export.json_document(load.limit(0), columns, [F.col("cycle_date")], NOW, "row_count", "rows")
    assert json.loads("\n".join(r.value for r in empty.collect()))["rows"] == []


def test_ties_do_not_depend_on_the_order_of_rows(spark):
    ev = derive.events(spark, "/root/testdata/sf0.001")
    raw = derive.raw_cycles(ev).where("score is not null").limit(200).cache()
    twin = raw.withColumn("score", F.col("score").withField("kilojoule", F.col("score.kilojoule") + 1))
    found = {tuple(rows(staging.stg_raw_cycles(a.unionByName(b).repartition(n)))) for a, b, n in ((raw, twin, 1), (twin, raw, 5), (twin, raw, 3))}
    assert len(found) == 1
    days = spark.createDataFrame([(c, 1, DAY, float(c % 7)) for c in range(40)], "cycle_id long, user_id long, cycle_date date, strain_score double")
    rest = "recovery_score sleep_performance_pct total_sleep_hours hrv_rmssd_milli resting_heart_rate sws_hours rem_hours".split()
    days = days.withColumns({c: F.col("strain_score") for c in rest} | {c: F.lit("x") for c in ("recovery_bucket", "sleep_quality_label")})
    assert len({tuple(rows(marts.my_trends(days.repartition(n)))) for n in (1, 3, 7)}) == 1


def test_raw_tables(spark, database):
    for name in RAW_TABLES:
        tables.ensure_table(spark, name, database)
        tables.ensure_table(spark, name, database)
    users = spark.createDataFrame([(1, "a", None, None, NOW)], "user_id long, email string, first_name string, last_name string, loaded_at timestamp")
    assert tables.append_raw(users, "raw_users", database) == 1
    assert tables.append_raw(users, "raw_users", database) == 1
    assert tables.append_raw(users.where("false"), "raw_users", database) == 0
    assert spark.table(f"{database}.raw_users").count() == 2
    with pytest.raises(PySparkException):
        tables.append_raw(users.withColumn("user_id", F.lit(None).cast("long")), "raw_users", database)
    assert AUDIT_TABLE not in tables.reset_tables(spark, database=database)
    assert spark.table(f"{database}.raw_users").count() == 0
    with pytest.raises(KeyError):
        tables.reset_tables(spark, ["raw_unknown"], database)


def test_watermark_and_since(spark):
    df = spark.createDataFrame([(1, datetime(2024, 6, 1)), (2, datetime(2024, 6, 2, 1, 2, 3, 4)), (3, None)], "id int, end timestamp")
    mark = tables.watermark(df, "end")
    assert mark == datetime(2024, 6, 2, 1, 2, 3, 4, tzinfo=timezone.utc)
    assert tables.watermark(df.where("false"), "end") is None
    assert rows(tables.since(df, "end", mark).select("id")) == [(2,), (3,)]
    assert rows(tables.since(df, "end", datetime(2024, 6, 1)).select("id")) == [(1,), (2,), (3,)]
    assert tables.since(df, "end", None).count() == 3


def landed(spark, tmp_path, kind, *records):
    path = tmp_path / f"{kind}-{len(list(tmp_path.iterdir()))}"
    path.mkdir()
    (path / "part.json").write_text("\n".join(json.dumps(r) for r in records))
    return lambda: spark.read.schema(landing_schema(kind)).json(str(path))


def test_audited_load(spark, database, tmp_path):
    for name in ("raw_cycles", "raw_strava_runs", AUDIT_TABLE):
        tables.ensure_table(spark, name, database)
    first = landed(spark, tmp_path, "cycles", {"id": 1, "user_id": 9, "end": "2024-06-01T00:00:00Z"}, {"id": 2, "user_id": 9, "end": "2024-06-02T00:00:00Z"})
    dry = tables.audited_load(spark, "cycles", first, database, dry_run=True, now=lambda: NOW)
    assert (dry.rows_fetched, dry.rows_inserted, dry.status) == (2, 0, "success")
    assert spark.table(f"{database}.{AUDIT_TABLE}").count() == 0

    row = tables.audited_load(spark, "cycles", first, database, now=lambda: NOW)
    assert (row.endpoint, row.rows_fetched, row.rows_inserted, row.watermark_start) == ("cycles", 2, 2, None)
    assert row.watermark_end == NOW and row.error_msg is None

    later = landed(spark, tmp_path, "cycles", {"id": 1, "user_id": 9, "end": "2024-06-01T00:00:00Z"}, {"id": 2, "user_id": 9, "end": "2024-06-02T00:00:00Z"}, {"id": 3, "user_id": 9, "end": "2024-06-03T00:00:00Z"})
    row = tables.audited_load(spark, "cycles", later, database, now=lambda: NOW, from_mark=True)
    assert row.rows_inserted == 2 and row.watermark_start == datetime(2024, 6, 2, tzinfo=timezone.utc)

    # A cycle that is still running, and an older one with a new score, are part of what lands.
    more = landed(spark, tmp_path, "cycles", {"id": 4, "user_id": 9, "start": "2024-06-04T00:00:00Z"}, {"id": 1, "user_id": 9, "end": "2024-06-01T00:00:00Z", "score": {"strain": 7.5}})
    row = tables.audited_load(spark, "cycles", more, database, now=lambda: NOW)
    assert (row.rows_fetched, row.rows_inserted) == (2, 2)
    assert rows(spark.table(f"{database}.raw_cycles").where("end is null").select("id")) == [(4,)]
    assert rows(spark.table(f"{database}.raw_cycles").where("score.strain = 7.5").select("id")) == [(1,)]

    runs = landed(spark, tmp_path, "runs", {"id": 5, "sport_type": "Run"}, {"id": 6, "sport_type": "Ride"})
    assert tables.audited_load(spark, "runs", runs, database).endpoint == "strava_runs"

    def broken():
        raise RuntimeError("no landing")

    row = tables.audited_load(spark, "cycles", broken, database, now=lambda: NOW)
    assert (row.status, row.rows_inserted, row.watermark_end, row.error_msg) == ("failed", 0, None, "no landing")
    audit = spark.table(f"{database}.{AUDIT_TABLE}")
    assert audit.count() == 5 and spark.table(f"{database}.raw_cycles").count() == 6
    assert rows(tables.audit_summary(audit)) == [("cycles", 4, 6, 6, 1), ("strava_runs", 1, 1, 1, 0)]
    assert tuple(tables.audit_totals(audit).first()) == (7, ["cycles"])


def test_nightly_load(spark, database, tmp_path):
    sources = {
        "cycles": landed(spark, tmp_path, "cycles", {"id": 1, "user_id": 9}),
        "runs": landed(spark, tmp_path, "runs", {"id": 5, "sport_type": "Run"}, {"id": 6, "sport_type": "Run"}),
        "users": landed(spark, tmp_path, "users", {"user_id": 9, "first_name": "A"}),
        "photos": landed(spark, tmp_path, "photos", {"id": 5, "photos": []}, {"id": 7, "photos": []}),
    }
    assert [r.rows_fetched for r in tables.nightly_load(spark, sources, database, dry_run=True)] == [1, 2]
    assert spark.table(f"{database}.raw_users").count() == 0
    for _ in range(2):
        records = tables.nightly_load(spark, sources, database)
        assert [(r.endpoint, r.status) for r in records] == [("cycles", "success"), ("strava_runs", "success")]
    assert spark.table(f"{database}.raw_users").count() == 2
    assert rows(spark.table(f"{database}.raw_strava_photos").select("id", "photo_count")) == [(5, 0)]
    assert spark.table(f"{database}.{AUDIT_TABLE}").count() == 4

    def broken():
        raise RuntimeError("no landing")

    records = tables.nightly_load(spark, {"users": broken, "cycles": broken}, database)
    assert [r.status for r in records] == ["failed"]


def one_row_group(spark, folder):
    """A table of 40 events in a file of one row group."""
    ids = spark.range(0, 40, 1, 1)
    stamp, kind = F.timestamp_seconds(1_705_000_000 + F.col("id") * 30_000), F.element_at(F.array(F.lit("click"), F.lit("view")), (F.col("id") % 2 + 1).cast("int"))
    columns = {"event_id": F.col("id"), "ts": stamp, "user_id": F.col("id") % 3, "event_type": kind, "value": F.lit(1.0), "props": F.lit('{"k": 1}')}
    ids.select(*[c.alias(name) for name, c in columns.items()]).write.parquet(f"{folder}/events.parquet")


def test_loads_of_one_row_group_use_many_tasks(spark, tmp_path, monkeypatch):
    """All passes of the nightly loads over the events are spread, though the file of events has one row group."""
    spread = []

    def load(_, landed, *args, **kwargs):
        spread.extend(df().groupBy(F.spark_partition_id()).count().count() for df in landed.values())

    one_row_group(spark, tmp_path)
    monkeypatch.setattr(tables, "nightly_load", load)
    monkeypatch.setattr(spark, "sql", lambda text: None)
    queries._nights(spark, str(tmp_path), "unused")
    assert len(spread) == 21 and min(spread) > 1


def test_build_of_one_row_group_uses_many_tasks(spark, tmp_path, monkeypatch):
    """All raw tables of the build are made of spread events, though the file of events has one row group."""
    spread = []

    def sources(ev):
        spread.append(ev.groupBy(F.spark_partition_id()).count().count())
        return {}

    one_row_group(spark, tmp_path)
    monkeypatch.setattr(queries, "_raw_sources", sources)
    monkeypatch.setattr(marts, "build", lambda *args, **kwargs: {})
    monkeypatch.setattr(quality, "check_models", lambda *args: spark.range(1))
    queries.build_checks(spark, str(tmp_path))
    assert spread and min(spread) > 1


def test_freshness(spark):
    df = spark.createDataFrame([(NOW - timedelta(hours=30),), (NOW - timedelta(hours=99),)], "loaded_at timestamp")
    assert tables.freshness(df, NOW).first().status == "warn"
    assert tables.freshness(df, NOW, 49, 97).first().status == "pass"
    assert tables.freshness(df, NOW + timedelta(hours=20)).first().status == "error"
    assert tables.freshness(df.where("false"), NOW).first().status == "error"


def test_quality(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b"), (None, "b"), (None, None)], "k int, v string")
    assert rows(quality.check_not_null(df, ["k", "v"])) == [("not_null", "k", 2), ("not_null", "v", 1)]
    assert rows(quality.check_unique(df, ["k"])) == [("unique", "k", 1)]
    assert rows(quality.check_unique(df, ["k", "v"])) == [("unique", "k, v", 0)]
    assert sum(map(len, quality.NOT_NULL.values())) == 35 and sum(map(len, quality.UNIQUE.values())) == 13


def read_document(document, path):
    export.write_document(document, str(path))
    parts = sorted(p for p in path.iterdir() if p.name.startswith("part-"))
    return json.loads("".join(p.read_text() for p in parts))


def test_export_is_one_document(spark, tmp_path):
    load = spark.range(500).select(
        F.date_add(F.lit(DAY), F.pmod(F.hash("id"), F.lit(90))).alias("cycle_date"),
        F.col("id").alias("user_id"),
        *[F.when(F.col("id") % 3 > 0, F.col("id") / 2.0).alias(c) for c in export.DAILY_LOAD_COLUMNS[2:]],
    )
    document = read_document(export.daily_load_document(load.repartition(5), NOW), tmp_path / "daily")
    assert list(document) == ["generated_at", "row_count", "description", "rows"]
    assert document["generated_at"] == "2024-07-01T06:00:00+00:00" and document["row_count"] == 500
    keys = [(r["cycle_date"], int(r["user_id"])) for r in document["rows"]]
    assert len(keys) == 500 and keys == sorted(keys)
    assert list(document["rows"][0]) == export.DAILY_LOAD_COLUMNS
    assert sum(r["ctl"] is None for r in document["rows"]) == 167

    empty = read_document(export.daily_load_document(load.where("false"), NOW), tmp_path / "empty")
    assert empty["rows"] == [] and empty["row_count"] == 0


def test_export_rows_move_as_columns(spark, monkeypatch):
    """Rows are put in order as columns, with equal ones in the order of their JSON, which no shuffle before it carries."""
    moved = []
    monkeypatch.setattr(export, "positions", lambda df, *a, positions=export.positions, **k: positions(moved.append(df) or df, *a, **k))
    df = spark.createDataFrame([(2, "b", None), (1, "z", 9), (1, "z", 10), (1, "a", 9), (1, None, 9)], "n long, name string, m long")
    lines = export.json_document(df, ["n", "name", "m"], [F.col("n")], NOW, "row_count", "rows")
    got = [json.loads(r.value[1:]) for r in lines.collect()[1:-1]]
    want = [{"n": 1, "name": None, "m": 9}, {"n": 1, "name": "a", "m": 9}, {"n": 1, "name": "z", "m": 10}, {"n": 1, "name": "z", "m": 9}]
    ordered = sorted(want, key=lambda r: json.dumps(r, separators=(",", ":")))
    assert got == [*ordered, {"n": 2, "name": "b", "m": None}]
    assert moved[0].columns[:3] == ["n", "name", "m"] and not any(str(v).startswith("{") for r in moved[0].collect() for v in r)


def test_export_runs(spark, tmp_path):
    stamps = [datetime(2024, 6, 1, 7), datetime(2024, 6, 1, 7, 0, 0, 120000), datetime(2024, 6, 1, 7, 0, 0, 1)]
    runs = spark.createDataFrame(
        [(1, DAY, stamps[0]), (2, DAY + timedelta(1), stamps[1]), (3, None, stamps[2])], "run_id long, run_date date, run_start timestamp"
    ).withColumn("loaded_at", F.col("run_start"))
    runs = runs.withColumns({c: F.lit(None).cast("double") for c in export.RUN_COLUMNS if c not in runs.columns})
    document = read_document(export.runs_document(runs, NOW.replace(tzinfo=None)), tmp_path / "runs")
    assert list(document) == ["generated_at", "run_count", "runs"] and len(export.RUN_COLUMNS) == 33
    assert [r["run_id"] for r in document["runs"]] == ["2", "1", "3"]
    assert [r["run_start"] for r in document["runs"]] == [
        "2024-06-01 07:00:00.120+00", "2024-06-01 07:00:00+00", "2024-06-01 07:00:00.000001+00",
    ]
    assert [r["run_date"] for r in document["runs"]] == ["2024-06-21", "2024-06-20", None]


def test_streams(spark, database, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    (folder / "a.json").write_text("\n".join(json.dumps({"id": i, "sport_type": s, "start_date": "2024-06-20T07:00:00Z"}) for i, s in enumerate(["Run", "Ride", "Run"])))
    stream = ingest.stream_landing(spark, "runs", str(folder))
    once = ingest.drop_repeats(stream, ["id"], "start_date")
    table = f"{database}.raw_runs_stream"
    where = ingest.checkpoint_location(spark, database)
    ingest.stream_to_table(once, table, f"{where}/raw").awaitTermination()
    (folder / "b.json").write_text(json.dumps({"id": 0, "sport_type": "Run", "start_date": "2024-06-20T07:00:00Z"}))
    ingest.stream_to_table(once, table, f"{where}/raw").awaitTermination()
    assert rows(spark.table(table).select("id")) == [(0,), (2,)]

    facts = stream.select("id", F.to_date("start_date").alias("d"), "sport_type", "loaded_at")
    ingest.stream_to_mart(facts, f"{database}.fact", "id", "d", f"{where}/mart").awaitTermination()
    assert rows(read_mart(spark, f"{database}.fact").select("id", "sport_type")) == [(0, "Run"), (2, "Run")]


def test_nulls_are_counted_while_writing(spark, database):
    df = spark.createDataFrame([(1, None), (None, None), (2, "a")], "user_id long, v string").repartition(3)
    assert marts.write_model(df, f"{database}.m", required=["user_id", "v"]) == {"user_id": 1, "v": 2}
    assert marts.write_model(df.limit(0), f"{database}.m", required=["v"]) == {"v": 0} and marts.write_model(df, f"{database}.m") == {}


def test_build(spark, database):
    events = derive.events(spark, "/root/testdata/sf0.001")
    raw = {
        "raw_cycles": derive.raw_cycles(events),
        "raw_sleeps": derive.raw_sleeps(events),
        "raw_recoveries": derive.raw_recoveries(events),
        "raw_workouts": derive.raw_workouts(events),
        "raw_users": derive.raw_users(events),
        "raw_strava_photos": derive.raw_photos(events),
        "raw_strava_runs": derive.raw_runs(events),
    }
    for name, df in raw.items():
        df.write.saveAsTable(f"{database}.{name}")
    built = f"{database}_models"
    spark.sql(f"DROP DATABASE IF EXISTS {built} CASCADE")
    for _ in range(2):
        nulls = marts.build(spark, database, built, NOW, user_col="user_id", buckets=4)
    counted = quality.check_models(spark, built, nulls)
    assert len(nulls) == 7 and rows(counted) == rows(quality.check_models(spark, built).select(*counted.columns))
    for model in quality.NOT_NULL:
        df = spark.table(model if model.startswith("stg_") else f"{built}.{model}")
        assert df.count() > 0
        # A run without its own date key or user would be a defect of the derived data.
        assert [r for r in quality.check_model(df, model).collect() if r.failures] == []
    kept = f"{database}_kept"
    spark.sql(f"DROP DATABASE IF EXISTS {kept} CASCADE")
    for _ in range(2):
        nulls = marts.build(spark, database, kept, NOW, user_col="user_id", carry_load=True)
    assert nulls["int_training_load"] == {"cycle_date": 0, "user_id": 0}
    for model in ("int_training_load", "fct_weekly_training_summary"):
        plain = spark.table(f"{built}.{model}")
        assert rows(spark.table(f"{kept}.{model}").select(*plain.columns)) == rows(plain)
    upsert_module.drop_mart(spark, f"{kept}.int_training_load")
    spark.sql(f"DROP DATABASE {kept} CASCADE")
    plan = marts.my_trends(spark.table(f"{built}.int_daily_metrics"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    spark.sql(f"DROP DATABASE {built} CASCADE")


def test_late_rows_of_open_and_closed_weeks(spark, tmp_path):
    """A late row changes a week that is still open and is dropped for a closed one; a second run goes on from the state."""
    folder, place = tmp_path / "landed", f"{tmp_path}/out"
    folder.mkdir()
    ev = "event_id long, ts timestamp, user_id long, event_type string, cents long, k long"

    def run(*events):
        records = [{"event_id": i, "ts": f"2024-{day}T12:00:00Z", "user_id": 1, "event_type": "view", "cents": 2100, "k": i} for i, day in events]
        (folder / f"{len(list(folder.iterdir()))}.json").write_text("\n".join(map(json.dumps, records)))
        stream = weeks.weekly_load_stream(derive.load_rows(spark.readStream.schema(ev).json(str(folder))), delay="10 days")
        weeks.write_weeks(stream, f"{place}/weeks", f"{place}/state").awaitTermination()
        return rows(weeks.read_weeks(spark, f"{place}/weeks").select("week_start", "tracked_days", "total_weekly_tss"))

    first, second, third = date(2024, 1, 1), date(2024, 1, 8), date(2024, 2, 5)
    assert run((1, "01-01"), (2, "01-07"), (3, "01-08")) == [(first, 2, 200.0), (second, 1, 100.0)]
    assert run((4, "01-03"), (5, "02-06")) == [(first, 3, 300.0), (second, 1, 100.0), (third, 1, 100.0)]
    assert run((6, "01-09"), (7, "02-07")) == [(first, 3, 300.0), (second, 1, 100.0), (third, 2, 200.0)]
