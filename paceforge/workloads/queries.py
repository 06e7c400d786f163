"""Driver queries: every operator and model over the driver's whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paceforge.functions import units as u
from paceforge.operators import aggregates, periods, quality, routes
from paceforge.operators.joins import attach_days, missing_keys
from paceforge.operators.load import ewma_load
from paceforge.operators.nearest import nearest_match
from paceforge.operators.running import as_ordered
from paceforge.operators.upsert import drop_mart, merge_mart, read_mart, rescan_window, upsert
from paceforge.operators.versions import latest_version
from paceforge.plans import marts, staging
from paceforge.plans.daily import int_daily_metrics
from paceforge.plans.carried import read_load, refresh_load
from paceforge.plans.load import fct_weekly_training_summary, int_training_load
from paceforge.plans.recovery import int_run_recovery, int_workout_recovery
from paceforge.sources import export, landing, tables
from paceforge.sources.schemas import landing_schema
from paceforge.storage import shared_folder, stored
from paceforge.streaming import weeks
from paceforge.workloads import derive

Query = Callable[[SparkSession, str], DataFrame]

NOW = datetime(2024, 2, 1, tzinfo=timezone.utc)


def plain(df: DataFrame) -> DataFrame:
    """Dates, times and flags in a form that reads the same in any engine."""

    def show(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DateType, T.BooleanType)):
            c = c.cast("string")
        elif isinstance(f.dataType, T.TimestampType):
            c = F.unix_micros(c)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        return c.alias(f.name)

    return df.select(*[show(f) for f in df.schema])


# --- models over one set of events ----------------------------------------------------------------


def _workouts(ev: DataFrame) -> DataFrame:
    return staging.stg_raw_workouts(derive.raw_workouts(ev))


def _users(ev: DataFrame) -> DataFrame:
    return staging.stg_raw_users(derive.raw_users(ev))


def _runs(ev: DataFrame) -> DataFrame:
    return staging.stg_strava_runs(derive.raw_runs(ev), derive.raw_photos(ev), "user_id")


def _daily(ev: DataFrame) -> DataFrame:
    return int_daily_metrics(
        staging.stg_raw_cycles(derive.raw_cycles(ev)),
        staging.stg_raw_recoveries(derive.raw_recoveries(ev)),
        staging.stg_raw_sleeps(derive.raw_sleeps(ev)),
    )


def _run_recovery(ev: DataFrame) -> DataFrame:
    return int_run_recovery(_runs(ev), _daily(ev), _workouts(ev), "user_id")


def _load(ev: DataFrame) -> DataFrame:
    return int_training_load(_daily(ev))


def _weekly(ev: DataFrame, user_col: str | None) -> DataFrame:
    runs = _runs(ev).withColumnRenamed("average_heartrate", "run_avg_hr")
    return fct_weekly_training_summary(_load(ev), runs, user_col)


def stg_cycles(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stg_raw_cycles(derive.raw_cycles(derive.events(spark, sf)))


def stg_recoveries(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stg_raw_recoveries(derive.raw_recoveries(derive.events(spark, sf)))


def stg_sleeps(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stg_raw_sleeps(derive.raw_sleeps(derive.events(spark, sf)))


def stg_workouts(spark: SparkSession, sf: str) -> DataFrame:
    return _workouts(derive.events(spark, sf))


def stg_users(spark: SparkSession, sf: str) -> DataFrame:
    return _users(derive.events(spark, sf))


def stg_runs(spark: SparkSession, sf: str) -> DataFrame:
    return _runs(derive.events(spark, sf))


def latest_events(spark: SparkSession, sf: str) -> DataFrame:
    ev = derive.table(spark, sf, "events")
    return latest_version(ev, ["user_id", "event_type"], "ts", [F.desc("event_id")])


def daily_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return _daily(derive.events(spark, sf))


def run_recovery(spark: SparkSession, sf: str) -> DataFrame:
    return _run_recovery(derive.events(spark, sf))


def workout_recovery(spark: SparkSession, sf: str) -> DataFrame:
    ev = derive.events(spark, sf)
    return int_workout_recovery(_workouts(ev), _daily(ev))


def training_load(spark: SparkSession, sf: str) -> DataFrame:
    return _load(derive.events(spark, sf))


def weekly_summary(spark: SparkSession, sf: str) -> DataFrame:
    return _weekly(derive.events(spark, sf), "user_id")


def weekly_summary_all_users(spark: SparkSession, sf: str) -> DataFrame:
    """The join on the week alone: every user sees the runs of all."""
    return _weekly(derive.events(spark, sf), None)


def streamed_weeks(spark: SparkSession, sf: str) -> DataFrame:
    """Weekly load of every user over the events as a stream that takes all that is there."""
    schema = derive.utc(spark).read.parquet(f"{sf}/events.parquet").schema
    # A pattern: a stream takes no path of a single file.
    landed = derive.instants(spark.readStream.schema(schema).parquet(f"{sf}/events.parque[t]"))
    load = derive.load_rows(derive.read_events(landed))
    place = f"{shared_folder(spark)}/streamed-weeks-{uuid.uuid4().hex}"
    found = weeks.weekly_load_stream(load, order=F.struct("ts", "event_id"))
    weeks.write_weeks(found, f"{place}/weeks", f"{place}/state").awaitTermination()
    return weeks.read_weeks(spark, f"{place}/weeks")


def rolling_trends(spark: SparkSession, sf: str) -> DataFrame:
    return marts.my_trends(_daily(derive.events(spark, sf)))


def user_lifetime(spark: SparkSession, sf: str) -> DataFrame:
    ev = derive.events(spark, sf)
    return marts.dim_user(_daily(ev), _users(ev), NOW)


# --- joins and windows on the plain tables ------------------------------------------------------


def _customer_days(spark: SparkSession, sf: str) -> DataFrame:
    orders = derive.table(spark, sf, "orders")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    return orders.groupBy(
        F.col("o_custkey").alias("user_id"), F.to_date("o_orderdate").alias("cycle_date")
    ).agg((F.sum(cents).cast("double") / F.lit(1000000.0)).alias("day_load"))


def capped_load(spark: SparkSession, sf: str) -> DataFrame:
    return ewma_load(_customer_days(spark, sf), "day_load", digits=4)


def next_day_join(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with the totals of their own and of the next day, by date alone."""
    orders = derive.table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("o_date"), "o_totalprice"
    )
    cents = F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint"))
    days = orders.groupBy(F.col("o_date").alias("cycle_date")).agg(
        F.count(F.lit(1)).alias("n"), (cents.cast("double") / 100.0).alias("total")
    )
    same_day = {"n": "same_day_n", "total": "same_day_total"}
    next_day = {"n": "next_day_n", "total": "next_day_total"}
    both = attach_days(orders, days, {0: same_day, 1: next_day}, "o_date")
    return both.withColumn("delta", F.col("next_day_n") - F.col("same_day_n"))


def nearest_click(spark: SparkSession, sf: str) -> DataFrame:
    """Every purchase with the click nearest to it, of the same user and day."""
    ev = derive.events(spark, sf).select("event_id", "ts", "d", "user_id", "event_type", "cents")
    return nearest_match(
        ev.where(F.col("event_type") == "purchase"),
        ev,
        on=["user_id", "d"],
        left_ts="ts",
        right_ts="ts",
        right_key="event_id",
        columns={"event_id": "click_id", "ts": "click_ts", "cents": "click_cents"},
        pred=F.lower("event_type").like("%click%"),
    )


def nearest_any_user(spark: SparkSession, sf: str) -> DataFrame:
    """Every purchase with the nearest signup of its day, of any user: the join on date alone."""
    ev = derive.events(spark, sf).select("event_id", "ts", "d", "event_type")
    return nearest_match(
        ev.where(F.col("event_type") == "purchase"),
        ev,
        on=["d"],
        left_ts="ts",
        right_ts="ts",
        right_key="event_id",
        columns={"event_id": "signup_id"},
        pred=F.col("event_type") == "signup",
    )


def missing_photos(spark: SparkSession, sf: str) -> DataFrame:
    ev = derive.events(spark, sf)
    return as_ordered(missing_keys(derive.raw_runs(ev), derive.raw_photos(ev), "id"))


def customers_without_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Customers without an order in 1997."""
    orders = derive.table(spark, sf, "orders").where(F.year("o_orderdate") == 1997)
    customers = derive.table(spark, sf, "customer").withColumnRenamed("c_custkey", "o_custkey")
    return missing_keys(customers, orders, "o_custkey")


# --- upsert, ingest and quality -----------------------------------------------------------------


def incremental_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Orders up to mid-2001 as the mart; all orders, repriced, as the source."""
    orders = derive.table(spark, sf, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("o_date"), "o_totalprice", "o_orderstatus"
    )
    mart = orders.where(F.col("o_date") < F.lit("2001-06-01").cast("date"))
    source = orders.select(
        "o_orderkey",
        "o_date",
        (F.col("o_totalprice") * 2).alias("o_totalprice"),
        F.lower("o_orderstatus").alias("o_note"),
    )
    return upsert(mart, rescan_window(source, mart, "o_date"), "o_orderkey")


def merged_mart(spark: SparkSession, sf: str) -> DataFrame:
    """A mart of the orders up to mid-2001 after two merges: all orders repriced, with other columns, and then repriced again."""
    orders = derive.table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("o_date"), "o_totalprice", "o_orderstatus")
    noted = orders.select("o_orderkey", "o_date", (F.col("o_totalprice") * 2).alias("o_totalprice"), F.lower("o_orderstatus").alias("o_note"))
    again = noted.withColumn("o_totalprice", F.col("o_totalprice") * 2)
    mart = f"merged_mart_{uuid.uuid4().hex[:8]}"
    for source in (orders.where(F.col("o_date") < F.lit("2001-06-01").cast("date")), noted, again):
        merge_mart(source, mart, "o_orderkey", "o_date")
    merged = stored(read_mart(spark, mart))
    drop_mart(spark, mart)
    return merged


def carried_load(spark: SparkSession, sf: str) -> DataFrame:
    """Training load kept from build to build: built while some users lacked their last days and others had other strains, then refreshed."""
    daily = stored(_daily(derive.events(spark, sf)))
    newest = daily.agg(F.max("cycle_date")).scalar()
    strain = F.when(F.col("user_id") % 5 == 1, F.col("strain_score") + F.dayofmonth("cycle_date")).otherwise(F.col("strain_score"))
    before = daily.where((F.col("user_id") % 7 != 0) | (F.col("cycle_date") < F.date_sub(newest, 30))).withColumn("strain_score", strain)
    mart = f"carried_load_{uuid.uuid4().hex[:8]}"
    for source in (before, daily, daily):
        refresh_load(source, mart)
    refreshed = stored(read_load(spark, mart))
    drop_mart(spark, mart)
    return refreshed


def _landed(ev: DataFrame, kind: str, record: Column) -> DataFrame:
    """Landed records of one kind, parsed from JSON text made of each event."""
    parsed = ev.select(F.from_json(record, landing_schema(kind)).alias("r"), "ts")
    return parsed.select("r.*", "ts")


def _json(*pairs: tuple[str, Column]) -> Column:
    """JSON text of an object whose values are JSON texts already."""
    parts = [F.concat(F.lit(f'"{name}":'), value) for name, value in pairs]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def _n(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _s(c: Column) -> Column:
    return F.concat(F.lit('"'), c, F.lit('"'))


def _iso(c: str = "ts") -> Column:
    return _s(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))


def _score(full: Column) -> Column:
    """A full score, an empty one, null, or one with a single NULL field, by event type."""
    kind = F.col("event_type")
    return (
        F.when(kind == "click", "{}").when(kind == "view", "null").when(kind == "error", '{"strain":null}').otherwise(full)
    )


def _counted(names: Sequence[str], start: int = 0) -> list[tuple[str, Column]]:
    """Each name with the count of the event plus its own number."""
    return [(name, _n(F.col("k") + (start + i))) for i, name in enumerate(names)]


def _record(*pairs: tuple[str, Column]) -> Column:
    """A landed record with what all of them share."""
    zone, state = ("timezone_offset", F.lit('"+01:00"')), ("score_state", F.lit('"SCORED"'))
    return _json(("user_id", _n("user_id")), ("start", _iso()), ("end", _iso()), zone, state, *pairs)


def _flat(rows: DataFrame, *structs: str) -> DataFrame:
    """All columns, with the fields of the named structs in place of them and a flag for whether each is there."""
    there = [F.col(s).isNotNull().alias(f"has_{s.split('.')[-1]}") for s in structs]
    inner = {s.split(".")[-1] for s in structs}
    fields = [F.col(f"{s}.{f}") for s in structs for f in rows.select(f"{s}.*").columns if f not in inner]
    return rows.select(*[c for c in rows.columns if c not in inner], *there, *fields)


def conform_cycles(spark: SparkSession, sf: str) -> DataFrame:
    ev = derive.events(spark, sf)
    score = _json(*_counted(landing.raw_field("raw_cycles", "score").names))
    record = _record(("id", _n("event_id")), ("score", _score(score)))
    return _flat(landing.conform_cycles(_landed(ev, "cycles", record), F.col("ts")), "score")


def conform_sleeps(spark: SparkSession, sf: str) -> DataFrame:
    ev = derive.events(spark, sf)
    stages = _counted(landing.raw_field("raw_sleeps", "score.stage_summary").names)
    needs = _counted(landing.raw_field("raw_sleeps", "score.sleep_needed").names, 10)
    plain = _counted(landing.raw_field("raw_sleeps", "score").names[2:], 20)
    score = _json(("stage_summary", _json(*stages)), ("sleep_needed", _json(*needs)), *plain)
    ids = (("id", _s(_n("event_id"))), ("cycle_id", _n("k")), ("v1_id", _n("cents")), ("nap", _n(F.col("k") > 50)))
    rows = landing.conform_sleeps(_landed(ev, "sleeps", _record(*ids, ("score", _score(score)))), F.col("ts"))
    return _flat(rows, "score", "score.stage_summary", "score.sleep_needed")


def conform_recoveries(spark: SparkSession, sf: str) -> DataFrame:
    ev = derive.events(spark, sf)
    score = _json(("user_calibrating", _n(F.col("k") > 50)), *_counted(landing.raw_field("raw_recoveries", "score").names[1:]))
    ids = (("cycle_id", _n("event_id")), ("sleep_id", _s(_n("k"))), ("created_at", _iso()), ("updated_at", _iso()))
    return _flat(landing.conform_recoveries(_landed(ev, "recoveries", _record(*ids, ("score", _score(score)))), F.col("ts")), "score")


def conform_workouts(spark: SparkSession, sf: str) -> DataFrame:
    ev = derive.events(spark, sf)
    zones = _json(*_counted(landing.raw_field("raw_workouts", "score.zone_duration").names, 10))
    name = F.when(F.col("k") < 40, '"zone_durations"').when(F.col("k") < 80, '"zone_duration"').otherwise('"zones"')
    plain = _json(*_counted(landing.raw_field("raw_workouts", "score").names[:-1]))
    full = F.concat(F.regexp_replace(plain, r"\}$", ","), name, F.lit(":"), zones, F.lit("}"))
    ids = (("id", _s(_n("event_id"))), ("v1_id", _n("cents")), ("sport_id", _n("k")), ("sport_name", _s(F.col("event_type"))))
    rows = landing.conform_workouts(_landed(ev, "workouts", _record(*ids, ("score", _score(full)))), F.col("ts"))
    return _flat(rows, "score", "score.zone_duration")


def conform_runs(spark: SparkSession, sf: str) -> DataFrame:
    ev = derive.events(spark, sf)
    kind = F.col("event_type")
    sport = F.when(kind == "click", "Run").when(kind == "view", "TrailRun").when(kind == "signup", "VirtualRun").otherwise("Ride")
    route = F.when(kind == "click", "null").otherwise(_json(("summary_polyline", _s(F.concat(F.lit("p"), _n("k"))))))
    measures = _counted([f.name for f in landing_schema("runs")][4:-1])
    ids = (("id", _n("event_id")), ("name", _s(F.concat(F.lit("Run "), _n("k")))), ("sport_type", _s(sport)), ("start_date", _iso()))
    return landing.conform_runs(landing.only_runs(_landed(ev, "runs", _json(*ids, *measures, ("map", route)))), F.col("ts"))


def conform_users(spark: SparkSession, sf: str) -> DataFrame:
    customers = derive.table(spark, sf, "customer")
    record = _json(("user_id", _n("c_custkey")), ("first_name", _s(F.col("c_name"))), ("last_name", _s(F.col("c_mktsegment"))))
    landed = customers.select(F.from_json(record, landing_schema("users")).alias("r")).select("r.*")
    return landing.conform_users(landed, NOW)


def conform_photos(spark: SparkSession, sf: str) -> DataFrame:
    ev = derive.events(spark, sf)
    kind = F.col("event_type")
    url = F.concat(F.lit("u"), _n("event_id"))
    small = F.concat(F.lit('{"urls":{"100":"'), url, F.lit('"}}'))
    empty = F.lit('{"urls":{"600":""}}')
    photos = (
        F.when(kind == "click", "[]")
        .when(kind == "view", F.concat(F.lit("["), empty, F.lit(","), small, F.lit("]")))
        .when(kind == "signup", F.concat(F.lit("["), empty, F.lit("]")))
        .otherwise(F.concat(F.lit('[{"urls":{"600":"L'), url, F.lit('","100":"S"}}]')))
    )
    record = _json(("id", _n("event_id")), ("photos", photos))
    return landing.conform_photos(_landed(ev, "photos", record), F.col("ts"))


def high_water_marks(spark: SparkSession, sf: str) -> DataFrame:
    """Newest event and order time, and the records a load from half-way on would take."""
    ev = derive.table(spark, sf, "events")
    late = tables.since(ev, "ts", datetime(2024, 1, 15, 12))
    return ev.agg(F.max("ts").alias("watermark")).withColumn("late_rows", late.agg(F.count(F.lit(1))).scalar())


def _raw_sources(ev: DataFrame) -> dict[str, DataFrame]:
    return {
        "cycles": derive.raw_cycles(ev),
        "sleeps": derive.raw_sleeps(ev),
        "recoveries": derive.raw_recoveries(ev),
        "workouts": derive.raw_workouts(ev),
        "runs": derive.raw_runs(ev),
    }


def source_watermarks(spark: SparkSession, sf: str) -> DataFrame:
    """Watermark of each of the five sources."""
    ev = derive.events(spark, sf)
    found = [(name, tables.watermark(df, tables.SOURCES[name][1])) for name, df in _raw_sources(ev).items()]
    return spark.createDataFrame(found, "source string, watermark timestamp")


def required_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Gaps in the required columns of the raw tables, with users and load times taken out of some rows."""
    ev = derive.events(spark, sf)
    gapped = ev.withColumn("user_id", F.when(F.col("event_type") != "error", F.col("user_id")))
    sources = {**_raw_sources(gapped), "users": derive.raw_users(gapped)}
    reports = [
        tables.required_gaps(df.withColumn("loaded_at", F.when(F.col("user_id").isNotNull(), F.col("loaded_at"))), tables.SOURCES[name][0])
        for name, df in sources.items()
        if name in ("sleeps", "workouts", "runs", "users")
    ]
    return reduce(DataFrame.unionByName, reports)


def _landings(ev: DataFrame) -> dict[str, Callable[[], DataFrame]]:
    """Landed records of every source, one of each for every event; records of errors have no end."""
    score = _json(("strain", _n("k")))
    end = F.when(F.col("event_type") == "error", "null").otherwise(_iso())
    common = (("user_id", _n("user_id")), ("start", _iso()), ("end", end), ("score", score))
    records = {
        "cycles": _json(("id", _n("event_id")), *common),
        "sleeps": _json(("id", _s(_n("event_id"))), *common),
        "recoveries": _json(("cycle_id", _n("event_id")), ("user_id", _n("user_id")), ("updated_at", _iso())),
        "workouts": _json(("id", _s(_n("event_id"))), *common),
        "runs": _json(("id", _n("event_id")), ("sport_type", F.when(F.col("event_type") == "view", '"Ride"').otherwise('"Run"')), ("start_date", _iso())),
        "users": _json(("user_id", _n("user_id"))),
        "photos": _json(("id", _n("event_id")), ("photos", F.lit("[]"))),
    }
    return {kind: lambda kind=kind, record=record: _landed(ev, kind, record) for kind, record in records.items()}


def _nights(spark: SparkSession, sf: str, database: str) -> list[Row]:
    """Three nightly loads: half of the events, all of them with workouts that lack a user, and a dry run. Gives the last one's records."""
    ev = derive.dealt_events(spark, sf)
    early = ev.where(F.col("ts") < F.lit("2024-01-16").cast("timestamp"))
    broken = ev.withColumn("user_id", F.when(F.col("event_type") != "click", F.col("user_id")))
    spark.sql(f"CREATE DATABASE {database}")
    night = [NOW + timedelta(days=n) for n in range(3)]
    tables.nightly_load(spark, _landings(early), database, now=lambda: night[0])
    tables.nightly_load(spark, {**_landings(ev), "workouts": _landings(broken)["workouts"]}, database, now=lambda: night[1])
    return tables.nightly_load(spark, _landings(ev), database, dry_run=True, now=lambda: night[2])


def _in_database(spark: SparkSession, work: Callable[[str], DataFrame]) -> DataFrame:
    """What ``work`` makes with a database of its own, which is dropped again."""
    database = f"paceforge_{uuid.uuid4().hex[:8]}"
    try:
        return stored(work(database))
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def audit_records(spark: SparkSession, sf: str) -> DataFrame:
    """The audit records that three nightly loads leave or, the last one being dry, return."""

    def work(database: str) -> DataFrame:
        dry = _nights(spark, sf, database)
        kept = spark.table(f"{database}.pipeline_runs").withColumn("kept", F.lit(True))
        shown = spark.createDataFrame(dry, kept.drop("kept").schema).withColumn("kept", F.lit(False))
        return kept.unionByName(shown).drop("run_id")

    return _in_database(spark, work)


def loaded_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows, keys, running records and newest load of every raw table after the same loads, with photos emptied by a reset."""

    def work(database: str) -> DataFrame:
        _nights(spark, sf, database)
        tables.reset_tables(spark, ["raw_strava_photos"], database)
        key = {"raw_recoveries": "cycle_id", "raw_users": "user_id"}
        shown = []
        for name, mark in tables.SOURCES.values():
            df = spark.table(f"{database}.{name}")
            running = F.count_if(F.col(mark).isNull()) if mark else F.lit(0).cast("bigint")
            figures = df.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(key.get(name, "id")).alias("keys"), running.alias("running"), F.max("loaded_at").alias("newest"))
            shown.append(figures.select(F.lit(name).alias("name"), "*"))
        return reduce(DataFrame.unionByName, shown)

    return _in_database(spark, work)


def build_checks(spark: SparkSession, sf: str) -> DataFrame:
    """All declared checks of all models, on the tables and views that a build leaves."""

    def work(database: str) -> DataFrame:
        ev = derive.dealt_events(spark, sf)
        spark.sql(f"CREATE DATABASE {database}")
        raw = {tables.SOURCES[name][0]: df for name, df in _raw_sources(ev).items()}
        raw |= {"raw_users": derive.raw_users(ev), "raw_strava_photos": derive.raw_photos(ev)}
        for name, df in raw.items():
            df.write.saveAsTable(f"{database}.{name}")
        nulls = marts.build(spark, database, database, NOW, user_col="user_id")
        return quality.check_models(spark, database, nulls)

    return _in_database(spark, work)


def _audit(spark: SparkSession, sf: str) -> DataFrame:
    """Events as load records: one per event, errors as failed loads."""
    failed = F.col("event_type") == "error"
    return derive.events(spark, sf).select(
        F.concat(F.lit("source"), (F.col("k") % 10).cast("string")).alias("endpoint"),
        F.when(failed & (F.col("k") % 10 < 7), "failed").otherwise("success").alias("status"),
        F.when(failed, 0).otherwise(F.col("cents")).alias("rows_fetched"),
        F.when(failed, 0).otherwise(F.col("cents")).alias("rows_inserted"),
    )


def audit_summary(spark: SparkSession, sf: str) -> DataFrame:
    return tables.audit_summary(_audit(spark, sf))


def audit_totals(spark: SparkSession, sf: str) -> DataFrame:
    totals = tables.audit_totals(_audit(spark, sf))
    return totals.withColumn("failed_endpoints", F.concat_ws(",", "failed_endpoints"))


def source_freshness(spark: SparkSession, sf: str) -> DataFrame:
    """Freshness of the six raw tables that have limits at a fixed time, with sources that stopped a day, two and four ago."""
    ev = derive.events(spark, sf)

    def until(day: str) -> DataFrame:
        return ev.where(F.col("ts") < F.lit(day).cast("timestamp"))

    sources = {
        "raw_cycles": derive.raw_cycles(ev),
        "raw_sleeps": derive.raw_sleeps(until("2024-01-30")),
        "raw_recoveries": derive.raw_recoveries(until("2024-01-29")),
        "raw_workouts": derive.raw_workouts(until("2024-01-01")),
        "raw_users": derive.raw_users(ev),
        "raw_strava_runs": derive.raw_runs(until("2024-01-28")),
    }
    at = datetime(2024, 1, 30, 23, 30, tzinfo=timezone.utc)
    reports = [
        tables.freshness(df, at, *tables.FRESHNESS_HOURS[name]).withColumn("name", F.lit(name))
        for name, df in sources.items()
    ]
    return reduce(DataFrame.unionByName, reports)


def quality_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Declared checks of two models, and checks that fail on plain tables."""
    orders = derive.table(spark, sf, "orders").withColumn("o_day", F.to_date("o_orderdate"))
    ev = derive.events(spark, sf)
    workouts = derive.raw_workouts(ev)
    checks = [
        quality.check_model(_daily(ev), "int_daily_metrics"),
        quality.check_model(_load(ev), "int_training_load"),
        quality.check_unique(orders, ["o_custkey", "o_day"]).withColumn("model", F.lit("orders")),
        quality.check_not_null(workouts, ["id", "sport_name", "score"]).withColumn("model", F.lit("raw_workouts")),
        quality.check_unique(workouts, ["id"]).withColumn("model", F.lit("raw_workouts")),
    ]
    return reduce(DataFrame.unionByName, checks)


# --- periods ------------------------------------------------------------------------------------


def _speeded(spark: SparkSession, sf: str) -> DataFrame:
    return stg_runs(spark, sf).withColumn("speed_mph", u.speed_mph("avg_speed_kmh"))


def period_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Orders per year, month, ISO week and day."""
    orders = derive.table(spark, sf, "orders").withColumn("run_date", F.to_date("o_orderdate"))
    counts = [aggregates.period_counts(orders, g).withColumn("grain", F.lit(g)) for g in u.PERIOD_GRAINS]
    return reduce(DataFrame.unionByName, counts)


def highlights(spark: SparkSession, sf: str) -> DataFrame:
    return periods.highlights(_speeded(spark, sf))


def speed_scale(spark: SparkSession, sf: str) -> DataFrame:
    runs = periods.speed_scale(_speeded(spark, sf))
    return runs.select("run_id", "avg_speed_kmh", "speed_mph", "speed_position")


def speed_range(spark: SparkSession, sf: str) -> DataFrame:
    return periods.speed_range(_speeded(spark, sf))


def period_slots(spark: SparkSession, sf: str) -> DataFrame:
    """Share of each user's month that every run takes."""
    runs = stg_runs(spark, sf).withColumn("month", u.period_key("run_date", "month"))
    slots = periods.period_slots(runs, ["user_id", "month"])
    return slots.select("run_id", "user_id", "month", "slot_start", "slot_end")


def period_slots_all_users(spark: SparkSession, sf: str) -> DataFrame:
    """Share of each week that every run takes, all users together."""
    runs = stg_runs(spark, sf).withColumn("week", u.period_key("run_date", "week"))
    return periods.period_slots(runs, ["week"]).select("run_id", "week", "slot_start", "slot_end")


def newest_runs(spark: SparkSession, sf: str) -> DataFrame:
    return as_ordered(periods.newest(stg_runs(spark, sf), 25)).select("position", "run_id", "run_date", "distance_km")


def mapped_runs(spark: SparkSession, sf: str) -> DataFrame:
    return as_ordered(periods.mapped_runs(stg_runs(spark, sf))).select("position", "run_id", "run_date", "distance_km")


def runs_of_a_week(spark: SparkSession, sf: str) -> DataFrame:
    """Runs of one ISO week by speed, fastest first, with their rank."""
    week = periods.runs_in_period(_speeded(spark, sf), "week", "2024-W02")
    return as_ordered(periods.sorted_runs(week, "speed"), "rank").select("rank", "run_id", "run_date", "speed_mph")


# --- routes -------------------------------------------------------------------------------------


def _lined(spark: SparkSession, sf: str) -> DataFrame:
    return derive.raw_runs(derive.events(spark, sf)).withColumnRenamed("id", "run_id")


def _route_points(spark: SparkSession, sf: str) -> DataFrame:
    return routes.route_points(_lined(spark, sf))


def polyline_decode(spark: SparkSession, sf: str) -> DataFrame:
    return _route_points(spark, sf)


def route_failures(spark: SparkSession, sf: str) -> DataFrame:
    """Decoded and skipped lines, with every line of an event with an odd count cut by one."""
    line = F.col("summary_polyline")
    shorter = F.substring(line, F.lit(1), F.length(line) - 1)
    cut = F.when(F.col("moving_time_sec") % 120 == 60, shorter).otherwise(line)
    runs = _lined(spark, sf).withColumn("summary_polyline", cut)
    return routes.decode_failures(routes.decoded_routes(runs))


def _lengths(measured: DataFrame) -> DataFrame:
    shown = [u.settled_round(F.col(c), 3).alias(c) for c in ("segment_m", "distance_m")]
    return measured.select("run_id", "point_idx", *shown)


def route_lengths(spark: SparkSession, sf: str) -> DataFrame:
    """Distances found while the lines are decoded."""
    return _lengths(routes.measured_routes(_lined(spark, sf)))


def route_point_lengths(spark: SparkSession, sf: str) -> DataFrame:
    """The same distances from points as rows."""
    return _lengths(routes.cumulative_distance(_route_points(spark, sf)))


def user_tracks(spark: SparkSession, sf: str) -> DataFrame:
    """Distance along each user's events in time order, with a point made of every event."""
    points = derive.events(spark, sf).select(
        "user_id",
        "event_id",
        "ts",
        ((F.col("cents") % 1000 + 4000000).cast("double") / 100000.0).alias("lat"),
        ((F.col("k") * 7 - 7000000).cast("double") / 100000.0).alias("lng"),
    )
    measured = routes.cumulative_distance(points, ["user_id"], ["ts", "event_id"])
    return measured.select("user_id", "event_id", *[u.settled_round(F.col(c), 3).alias(c) for c in ("distance_m", "route_m")])


FRACTIONS = (0.0, 0.1, 0.25, 0.5, 0.75, 1.0)


def route_positions(spark: SparkSession, sf: str) -> DataFrame:
    at = routes.position_at(routes.measured_routes(_lined(spark, sf)), FRACTIONS)
    return at.select("run_id", "p", *[u.settled_round(F.col(c), 6).alias(c) for c in ("lat", "lng")])


def route_summary(spark: SparkSession, sf: str) -> DataFrame:
    return routes.summarize_decoded(routes.decoded_routes(_lined(spark, sf)))


def route_point_summary(spark: SparkSession, sf: str) -> DataFrame:
    """The same summary from points as rows."""
    return routes.route_summary(_route_points(spark, sf))


def route_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """Bounding box of the routes of each day."""
    runs = _lined(spark, sf).withColumn("d", F.to_date("start_date"))
    return routes.bounds_of_routes(routes.decoded_routes(runs, keep=["d"]), ["d"])


def route_centroid(spark: SparkSession, sf: str) -> DataFrame:
    center = routes.centroid(_route_points(spark, sf))
    return center.select(*[u.settled_round(F.col(c), 6).alias(c) for c in ("lat", "lng")])


# --- exports ------------------------------------------------------------------------------------


def export_runs(spark: SparkSession, sf: str) -> DataFrame:
    return export.export_rows(run_recovery(spark, sf), export.RUN_COLUMNS)


def export_daily_load(spark: SparkSession, sf: str) -> DataFrame:
    return export.export_rows(training_load(spark, sf), export.DAILY_LOAD_COLUMNS)


def export_weekly(spark: SparkSession, sf: str) -> DataFrame:
    return export.export_rows(weekly_summary(spark, sf), export.WEEKLY_COLUMNS)


def _parsed(document: DataFrame, rows: DataFrame, columns: list[str], count: str) -> DataFrame:
    return export.parsed_document(document, export.export_rows(rows, columns).schema, count)


def export_document(spark: SparkSession, sf: str) -> DataFrame:
    """The JSON document of the daily load, parsed from its lines."""
    load = training_load(spark, sf)
    return _parsed(export.daily_load_document(load, NOW), load, export.DAILY_LOAD_COLUMNS, "row_count")


def export_weekly_document(spark: SparkSession, sf: str) -> DataFrame:
    """The JSON document of the weekly summary, parsed from its lines."""
    weekly = weekly_summary(spark, sf)
    return _parsed(export.weekly_document(weekly, NOW), weekly, export.WEEKLY_COLUMNS, "row_count")


def export_runs_document(spark: SparkSession, sf: str) -> DataFrame:
    """The JSON document of the runs, parsed from its lines."""
    runs = run_recovery(spark, sf)
    return _parsed(export.runs_document(runs, NOW), runs, export.RUN_COLUMNS, "run_count")


def late_and_running(spark: SparkSession, sf: str) -> DataFrame:
    """Cycles after a second load that brings running ones, without an end, and older ones with a new score."""
    ev = derive.events(spark, sf)
    first = derive.raw_cycles(ev)
    running = F.col("user_id") % 3 == 0
    later = first.where((F.col("user_id") % 2 == 0) & (F.col("score_state") == "SCORED")).select(
        *[
            {
                "end": F.when(~running, F.col("end")).alias("end"),
                "score": F.col("score").withField("strain", F.col("score.strain") + 1).alias("score"),
                "loaded_at": F.lit(NOW).alias("loaded_at"),
            }.get(c, F.col(c))
            for c in first.columns
        ]
    )
    mark = tables.watermark(first, "end")
    since = tables.since(later, "end", mark).agg(F.count(F.lit(1))).scalar()
    latest = staging.stg_raw_cycles(first.unionByName(later))
    return latest.select("cycle_id", "cycle_end", "strain_score", "loaded_at", since.alias("rows_from_mark"))


_ALL: tuple[Query, ...] = (
    stg_cycles,
    stg_recoveries,
    stg_sleeps,
    stg_workouts,
    stg_users,
    stg_runs,
    latest_events,
    daily_metrics,
    run_recovery,
    workout_recovery,
    training_load,
    weekly_summary,
    weekly_summary_all_users,
    streamed_weeks,
    rolling_trends,
    user_lifetime,
    capped_load,
    next_day_join,
    nearest_click,
    nearest_any_user,
    missing_photos,
    customers_without_orders,
    incremental_merge,
    merged_mart,
    carried_load,
    conform_cycles,
    conform_sleeps,
    conform_recoveries,
    conform_workouts,
    conform_runs,
    conform_users,
    conform_photos,
    high_water_marks,
    source_watermarks,
    required_gaps,
    audit_records,
    loaded_rows,
    build_checks,
    audit_summary,
    audit_totals,
    source_freshness,
    quality_checks,
    period_counts,
    highlights,
    speed_scale,
    speed_range,
    period_slots,
    period_slots_all_users,
    newest_runs,
    mapped_runs,
    runs_of_a_week,
    polyline_decode,
    route_failures,
    route_lengths,
    route_point_lengths,
    user_tracks,
    route_positions,
    route_summary,
    route_point_summary,
    route_bounds,
    route_centroid,
    export_runs,
    export_daily_load,
    export_weekly,
    export_document,
    export_weekly_document,
    export_runs_document,
    late_and_running,
)


def _shown(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(query(spark, sf_dir))

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


QUERIES: dict[str, Query] = {query.__name__: _shown(query) for query in _ALL}
