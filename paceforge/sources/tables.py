"""Raw tables: creation, appends, watermarks, audited loads and freshness."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Iterable, Mapping
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from paceforge.operators.joins import missing_keys
from paceforge.sources.landing import CONFORM, only_runs
from paceforge.sources.schemas import AUDIT_TABLE, RAW_TABLES, raw_schema

logger = logging.getLogger(__name__)

# Raw table and watermark column of each source; profiles and photos have none.
SOURCES = {
    "cycles": ("raw_cycles", "end"),
    "sleeps": ("raw_sleeps", "end"),
    "recoveries": ("raw_recoveries", "updated_at"),
    "workouts": ("raw_workouts", "end"),
    "runs": ("raw_strava_runs", "start_date"),
    "users": ("raw_users", None),
    "photos": ("raw_strava_photos", None),
}

# Name of a source in the audit table, where it differs.
AUDIT_NAMES = {"runs": "strava_runs"}

# Hours after which a table is late (warn) and too late (error).
FRESHNESS_HOURS = {
    "raw_cycles": (25, 49),
    "raw_sleeps": (25, 49),
    "raw_recoveries": (25, 49),
    "raw_workouts": (25, 49),
    "raw_users": (25, 49),
    "raw_strava_runs": (49, 97),
}


def ensure_table(spark: SparkSession, name: str, database: str = "default") -> None:
    """Create the database and the raw table if they are missing."""
    columns = ", ".join(
        f"`{field.name}` {field.dataType.simpleString()}" for field in raw_schema(name)
    )
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    spark.sql(f"CREATE TABLE IF NOT EXISTS `{database}`.`{name}` ({columns}) USING parquet")


def reset_tables(spark: SparkSession, names: Iterable[str] | None = None, database: str = "default") -> list[str]:
    """Drop and recreate raw tables; by default all but the audit table."""
    chosen = list(names) if names is not None else [name for name in RAW_TABLES if name != AUDIT_TABLE]
    for name in chosen:
        raw_schema(name)
    for name in chosen:
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")
        ensure_table(spark, name, database)
    return chosen


def append_raw(df: DataFrame, table: str, database: str = "default") -> int:
    """Append rows and return how many; the count is taken while writing.

    Required columns are checked in the same pass, as Parquet tables do not enforce them.
    """
    fields = raw_schema(table).fields
    rows = Observation()
    required = [
        F.coalesce(F.col(f.name), F.raise_error(F.lit(f"{table}.{f.name} is required"))).alias(f.name)
        if not f.nullable
        else F.col(f.name)
        for f in fields
    ]
    counted = df.select(*required).observe(rows, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("append").insertInto(f"`{database}`.`{table}`")
    return rows.get["rows"]


def required_gaps(df: DataFrame, table: str) -> DataFrame:
    """Rows without a value in each required column of a raw table, in one pass."""
    names = [f.name for f in raw_schema(table).fields if not f.nullable]
    counts = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in names])
    pairs = [F.struct(F.lit(name).alias("column"), F.col(name).alias("missing")) for name in names]
    return counts.select(F.lit(table).alias("table"), F.inline(F.array(*pairs)))


def audit_record(
    source: str,
    run_id: str,
    started_at: datetime,
    ended_at: datetime,
    fetched: int = 0,
    inserted: int = 0,
    watermark_start: datetime | None = None,
    watermark_end: datetime | None = None,
    error: str | None = None,
) -> Row:
    """What a load leaves in the audit table. A load that failed has an error, no rows and no new watermark."""
    values = {
        "run_id": run_id,
        "endpoint": AUDIT_NAMES.get(source, source),
        "started_at": started_at,
        "ended_at": ended_at,
        "rows_fetched": fetched if error is None else 0,
        "rows_inserted": inserted if error is None else 0,
        "watermark_start": watermark_start,
        "watermark_end": watermark_end if error is None else None,
        "status": "success" if error is None else "failed",
        "error_msg": error,
    }
    return Row(**{field.name: values[field.name] for field in raw_schema(AUDIT_TABLE)})


def _why(error: Exception, rows: DataFrame | None, table: str) -> str:
    """Reason of a failed load: required columns without a value, with the number of rows, or else the error itself."""
    try:
        gaps = [] if rows is None else required_gaps(rows, table).where("missing > 0").collect()
    except Exception:
        gaps = []
    return "; ".join(f"{table}.{gap.column} is missing in {gap.missing} rows" for gap in gaps) or str(error)


def watermark(df: DataFrame, column: str) -> datetime | None:
    """Highest value of ``column`` as an aware UTC time, or None for an empty table."""
    micros = df.agg(F.unix_micros(F.max(F.col(column).cast("timestamp")))).first()[0]
    if micros is None:
        return None
    return datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=micros)


def since(df: DataFrame, column: str, mark: datetime | None) -> DataFrame:
    """Records from the watermark on and those without a time, which are still running; all of them without a mark.

    It goes by the records' own times: a record that is older than the newest one and was changed since is not in it.
    """
    if mark is None:
        return df
    aware = mark if mark.tzinfo else mark.replace(tzinfo=timezone.utc)
    return df.where(F.col(column).isNull() | (F.col(column) >= F.lit(aware.isoformat()).cast("timestamp")))


def _utc_now() -> datetime:
    return datetime.now(timezone.utc)


def audited_load(
    spark: SparkSession,
    source: str,
    landed: Callable[[], DataFrame],
    database: str = "default",
    dry_run: bool = False,
    now: Callable[[], datetime] = _utc_now,
    from_mark: bool = False,
) -> Row:
    """Load what has landed of a source, and record the outcome.

    All that ``landed`` gives is loaded: records that are still running have no time yet, and an older record may have
    a new score. Staging keeps the latest version of each. ``from_mark`` takes only records from the watermark on.

    A failure inserts nothing and is recorded as ``failed`` instead of raised, so that the other
    sources still load. A dry run counts and writes neither rows nor record.
    """
    table, mark_column = SOURCES[source]
    run_id, started_at = str(uuid.uuid4()), now()
    rows, fetched, inserted, start, loaded_at, failure = None, 0, 0, None, None, None
    try:
        records = landed()
        if source == "runs":
            records = only_runs(records)
        if mark_column:
            start = watermark(spark.table(f"`{database}`.`{table}`"), mark_column)
            if from_mark:
                records = since(records, mark_column, start)
        loaded_at = now()
        rows = CONFORM[source](records, loaded_at)
        if dry_run:
            fetched = rows.count()
        else:
            fetched = inserted = append_raw(rows, table, database)
    except Exception as error:
        failure = _why(error, rows, table)
    row = audit_record(source, run_id, started_at, now(), fetched, inserted, start, loaded_at, failure)
    if not dry_run:
        append_raw(spark.createDataFrame([row], raw_schema(AUDIT_TABLE)), AUDIT_TABLE, database)
    return row


def load_users(spark: SparkSession, landed: DataFrame, database: str, now: datetime) -> int:
    """Append a profile snapshot per user; there is no watermark and no audit record."""
    return append_raw(CONFORM["users"](landed, now), "raw_users", database)


def load_photos(spark: SparkSession, landed: DataFrame, database: str, now: datetime) -> int:
    """Append photo records of the runs that have none yet."""
    runs, photos = (spark.table(f"`{database}`.`raw_strava_{name}`") for name in ("runs", "photos"))
    missing = missing_keys(runs, photos, "id")
    rows = CONFORM["photos"](landed, now).join(missing, "id", "left_semi")
    return append_raw(rows, "raw_strava_photos", database)


def nightly_load(
    spark: SparkSession,
    landed: Mapping[str, Callable[[], DataFrame]],
    database: str = "default",
    dry_run: bool = False,
    now: Callable[[], datetime] = _utc_now,
) -> list[Row]:
    """Load every source that has landed and return the audit records.

    Profiles come first and photos last. Both are extras: a failure of theirs is passed over. The
    load as a whole has failed if any record says so.
    """
    for name in RAW_TABLES:
        ensure_table(spark, name, database)

    def extra(source: str, load: Callable[[SparkSession, DataFrame, str, datetime], int]) -> None:
        if source not in landed or dry_run:
            return
        try:
            load(spark, landed[source](), database, now())
        except Exception:
            logger.exception("%s not loaded", source)

    extra("users", load_users)
    records = [
        audited_load(spark, source, landed[source], database, dry_run, now)
        for source, (_, mark) in SOURCES.items()
        if mark and source in landed
    ]
    extra("photos", load_photos)
    return records


def audit_summary(audit: DataFrame) -> DataFrame:
    """Rows fetched and inserted and number of failed loads, per source."""
    return audit.groupBy("endpoint").agg(
        F.count(F.lit(1)).alias("loads"),
        F.sum("rows_fetched").alias("rows_fetched"),
        F.sum("rows_inserted").alias("rows_inserted"),
        F.count_if(F.col("status") == "failed").alias("failed_loads"),
    )


def audit_totals(audit: DataFrame) -> DataFrame:
    """Total inserted and the failed sources in order, as one row."""
    failed = F.collect_set(F.when(F.col("failed_loads") > 0, F.col("endpoint")))
    return audit_summary(audit).agg(
        F.coalesce(F.sum("rows_inserted"), F.lit(0)).alias("total_inserted"),
        F.array_sort(failed).alias("failed_endpoints"),
    )


def freshness(
    df: DataFrame, now: datetime | Column, warn_hours: int = 25, error_hours: int = 49, loaded_at: str = "loaded_at"
) -> DataFrame:
    """Age of the newest load against its limits, as one row; an empty table is an error."""
    at = now if isinstance(now, Column) else F.lit(now).cast("timestamp")
    newest = df.agg(F.max(F.col(loaded_at).cast("timestamp")).alias("max_loaded_at"))
    age = F.timestamp_diff("SECOND", F.col("max_loaded_at"), at)
    status = (
        F.when(age.isNull() | (age > error_hours * 3600), "error")
        .when(age > warn_hours * 3600, "warn")
        .otherwise("pass")
    )
    return newest.select("max_loaded_at", age.alias("age_seconds"), status.alias("status"))
