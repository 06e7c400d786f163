"""Keyed upserts into a mart, with a look-back window.

A mart is a view on its current version, a table that is partitioned by month, and keeps an index from key to month. A merge writes the
months it touches beside those that are there, registers a new version that takes all other months from where they are, and
then replaces the view, which is one step of the catalog. A merge that stops before leaves the mart as it was, and what it has
written is removed by the next one.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paceforge.storage import folders, remove, stored

RESCAN_DAYS = 7
MONTH, BUCKET = "mart_month", "key_bucket"
#: Property of a mart's view that names its version.
VERSION = "mart_version"
#: Parts of the index from key to month, by a hash of the key.
KEY_BUCKETS = 32


def rescan_bound(target: DataFrame, date_col: str, days: int = RESCAN_DAYS) -> Column:
    """First date to read again: ``days`` before the newest date of the target, NULL if it is empty.

    It is a scalar subquery, run once inside the query that uses it.
    """
    return target.agg(F.date_sub(F.max(date_col), days)).scalar()


def rescan_window(
    source: DataFrame, target: DataFrame | None, date_col: str, days: int = RESCAN_DAYS
) -> DataFrame:
    """Source rows from the bound on; all of them without a target, and none if it is empty."""
    if target is None:
        return source
    return source.where(F.col(date_col) >= rescan_bound(target, date_col, days))


def sync_columns(target: DataFrame, source: DataFrame) -> DataFrame:
    """Target rows in the columns and types of the source: new ones are NULL, and others are dropped."""
    return target.select(
        *[
            (F.col(f.name) if f.name in target.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in source.schema
        ]
    )


def upsert(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Target with source rows in place of those of the same key, and with the new ones."""
    kept = target.join(source.select(key), key, "left_anti")
    return sync_columns(kept, source).unionByName(source)


def with_month(df: DataFrame, date_col: str) -> DataFrame:
    return df.withColumn(MONTH, F.coalesce(F.date_format(date_col, "yyyy-MM"), F.lit("none")))


def read_mart(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table).drop(MONTH)


def merge_mart(
    source: DataFrame,
    table: str,
    key: str,
    date_col: str,
    days: int | None = RESCAN_DAYS,
    version: str | None = None,
    buckets: int = KEY_BUCKETS,
) -> None:
    """Merge the rescan window of ``source`` into the mart ``table``, which the first call builds.

    Later calls find the newest date in the newest month alone, the months that hold changed keys in the parts of the index that those
    keys fall in, and read and write these months only. ``buckets`` is for the first call. A change of columns or of their types rewrites all. The lists of months
    and parts that come to the driver are bounded by the calendar and by ``buckets``.

    A key that is twice in the window is an error, and the mart stays as it was. ``days=None`` takes all of ``source``. With ``version``, a row
    stays if its version is newer than the one that comes. One merge at a time may write a mart; a query that is still
    reading the version before the current one must end before the next merge starts, which removes it.
    """
    spark = source.sparkSession
    held = _held(spark, table)
    months, parts = ({}, {}) if held is None else (_places(spark, _name(table, "v", held), MONTH), _places(spark, _name(table, "k", held), BUCKET))
    _clean(spark, table, held, {*months.values(), *parts.values()})
    attempt = uuid.uuid4().hex[:12]
    if held is None:
        if spark.catalog.tableExists(table):
            raise ValueError(f"{table} is no mart of this kind")
        written = _written(with_month(source, date_col), MONTH, f"{_home(spark, table)}/{attempt}/v")
        _refuse_repeats(written, key)
        _publish(spark, table, attempt, written, {}, _indexed(written, key, buckets), {}, buckets)
        return

    target = spark.table(_name(table, "v", held))
    window = source
    if days is not None:
        newest = max((m for m in months if m != "none"), default="none")
        window = rescan_window(source, target.where(F.col(MONTH) == newest), date_col, days)
    buckets = int(_properties(spark, table)[BUCKET])
    changed = stored(with_month(window, date_col).withColumn(BUCKET, _bucket(key, buckets)))
    _refuse_repeats(changed, key)
    index = spark.table(_name(table, "k", held))
    touched_parts = sorted(row[0] for row in changed.where(F.col(key).isNotNull()).select(BUCKET).distinct().collect())
    near = index.where(F.col(BUCKET).isin(touched_parts))
    before = near.join(changed.select(key), key, "left_semi").select(MONTH)
    old_months = {row[0] for row in before.distinct().collect()}
    if version:
        older = target.where(F.col(MONTH).isin(sorted(old_months))).select(F.col(key).alias("__key"), F.col(version).alias("__version"))
        newer = F.col("__version").isNull() | (F.col(version) >= F.col("__version"))
        changed = stored(changed.join(older, F.col(key) == F.col("__key"), "left").where(newer).select(*changed.columns))
    rows = changed.drop(BUCKET)
    same = _columns(rows) == _columns(target)
    touched = old_months | {row[0] for row in rows.select(MONTH).distinct().collect()}
    if same and not touched:
        return
    current = target.where(F.col(MONTH).isin(sorted(touched))) if same else target
    written = _written(upsert(current, rows, key), MONTH, f"{_home(spark, table)}/{attempt}/v")
    kept_months = {m: place for m, place in months.items() if m not in touched} if same else {}
    if same:
        entries = upsert(near, changed.where(F.col(key).isNotNull()).select(*near.columns), key)
        kept_parts = {b: place for b, place in parts.items() if int(b) not in touched_parts}
    else:
        entries, kept_parts = _indexed(written, key, buckets), {}
    _publish(spark, table, attempt, written, kept_months, entries, kept_parts, buckets)


def _columns(df: DataFrame) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in df.schema}


def _refuse_repeats(source: DataFrame, key: str) -> None:
    """An error if a key is there twice: which of the rows should stay?"""
    found = source.where(F.col(key).isNotNull()).groupBy(key).count().where(F.col("count") > 1).select(key).first()
    if found:
        raise ValueError(f"{key} {found[0]} is in the source more than once")


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def _indexed(rows: DataFrame, key: str, buckets: int) -> DataFrame:
    """(key, month, part) of every row with a key."""
    return rows.where(F.col(key).isNotNull()).select(key, MONTH, _bucket(key, buckets).alias(BUCKET))


def _name(table: str, kind: str, attempt: str) -> str:
    """Name of a version's rows (v) or index (k)."""
    return f"{table}__{kind}_{attempt}"


def _home(spark: SparkSession, table: str) -> str:
    """Folder of all versions of a mart."""
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{table.replace('.', '__')}__versions"


def _held(spark: SparkSession, table: str) -> str | None:
    """The version that the mart's view shows, None without a mart."""
    return _properties(spark, table).get(VERSION)


def _properties(spark: SparkSession, table: str) -> dict[str, str]:
    if not spark.catalog.tableExists(table):
        return {}
    return {row.key: row.value for row in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def _places(spark: SparkSession, name: str, by: str) -> dict[str, str]:
    """Folder of each partition of a version."""
    found = {}
    for row in spark.sql(f"SHOW PARTITIONS {name}").collect():
        value = row[0].split("=", 1)[1]
        details = spark.sql(f"DESCRIBE TABLE EXTENDED {name} PARTITION ({by} = '{value}')").collect()
        found[value] = next(d.data_type for d in details if d.col_name == "Location")
    return found


def _written(df: DataFrame, by: str, place: str) -> DataFrame:
    """``df`` written to a folder, a file or a few for each value of ``by``."""
    df.hint("rebalance", by).write.partitionBy(by).parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)


def _publish(
    spark: SparkSession,
    table: str,
    attempt: str,
    rows: DataFrame,
    months: Mapping[str, str],
    entries: DataFrame,
    parts: Mapping[str, str],
    buckets: int,
) -> None:
    """Make a version of the written ``rows`` and the kept ``months``, with its index, and show it."""
    home = f"{_home(spark, table)}/{attempt}"
    indexed = _written(entries, BUCKET, f"{home}/k")
    _registered(rows, MONTH, _name(table, "v", attempt), f"{home}/v", months)
    _registered(indexed, BUCKET, _name(table, "k", attempt), f"{home}/k", parts)
    _show(spark, table, attempt, buckets)


def _registered(rows: DataFrame, by: str, name: str, place: str, kept: Mapping[str, str]) -> None:
    """Table ``name`` of the partitions written to ``place`` and of those kept where they are."""
    spark = rows.sparkSession
    columns = [c for c in rows.columns if c != by]
    rows.select(*columns, by).limit(0).write.partitionBy(by).option("path", f"{place}_none").saveAsTable(name)
    new = {folder.split("=", 1)[1]: f"{place}/{folder}" for folder in folders(spark, place)}
    added = [f"PARTITION ({by} = '{value}') LOCATION '{where}'" for value, where in sorted({**kept, **new}.items())]
    if added:
        spark.sql(f"ALTER TABLE {name} ADD {' '.join(added)}")


def _show(spark: SparkSession, table: str, attempt: str, buckets: int) -> None:
    """Point the mart at a version: the one step that readers see."""
    spark.sql(
        f"CREATE OR REPLACE VIEW {table} TBLPROPERTIES ('{VERSION}' = '{attempt}', '{BUCKET}' = '{buckets}') "
        f"AS SELECT * FROM {_name(table, 'v', attempt)}"
    )


def _clean(spark: SparkSession, table: str, held: str | None, places: set[str]) -> None:
    """Remove the tables of all versions but the held one, and the folders that it does not use."""
    database, _, name = table.rpartition(".")
    for kind in ("v", "k"):
        for found in spark.catalog.listTables(*([database] if database else []), pattern=f"{name}__{kind}_*"):
            if held is None or found.name != f"{name}__{kind}_{held}":
                spark.sql(f"DROP TABLE {database}.{found.name}" if database else f"DROP TABLE {found.name}")
    home = _home(spark, table)
    used = {"/".join(place.rstrip("/").split("/")[-3:]) for place in places}
    for attempt in folders(spark, home):
        for kind in folders(spark, f"{home}/{attempt}"):
            for part in folders(spark, f"{home}/{attempt}/{kind}"):
                if f"{attempt}/{kind}/{part}" not in used:
                    remove(spark, f"{home}/{attempt}/{kind}/{part}")
        if not any(u.startswith(f"{attempt}/") for u in used):
            remove(spark, f"{home}/{attempt}")


def drop_mart(spark: SparkSession, table: str) -> None:
    """Remove a mart with all its versions."""
    spark.sql(f"DROP VIEW IF EXISTS {table}")
    _clean(spark, table, None, set())
