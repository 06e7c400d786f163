"""Training load kept from build to build: only what follows a change is worked out again.

The table is a mart of versions, in parts of one look-back (``LOOKBACK_DAYS`` + 1 days). Beside its rows each version keeps, for every
user and part, the number of input rows and a fingerprint of them. A refresh compares these with the input of
today and finds, for each user, the first part that changed. From there on the user's rows are worked out again; earlier parts
are read only as far back as the look-back and the windows of rows reach. Parts without a change stay where they are.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paceforge.operators.load import LOOKBACK_DAYS
from paceforge.operators.upsert import _clean, _held, _home, _name, _places, _registered, _show, _written
from paceforge.plans.load import LOAD_COLUMNS, int_training_load
from paceforge.storage import stored

PART = "load_part"
#: Rows before a row that its windows look at (the trends of seven rows ago).
ROWS_BEFORE = 7


def _part(day: str = "cycle_date") -> Column:
    return F.floor(F.unix_date(day) / F.lit(LOOKBACK_DAYS + 1)).cast("int")


def _fingerprints(daily: DataFrame) -> DataFrame:
    """(user_id, part, number of rows, sum of their hashes): summed before and after one shuffle, at most a row per user and part."""
    read = [c for c in LOAD_COLUMNS if c in daily.columns]
    mark = F.xxhash64(*read).cast("decimal(20,0)")
    return daily.groupBy("user_id", PART).agg(F.count(F.lit(1)).alias("n"), F.sum(mark).alias("mark"))


def _changed(now: DataFrame, before: DataFrame) -> DataFrame:
    """(user_id, first): the first part of each user with other rows than before, also where all its rows are gone."""
    a, b = now.alias("a"), before.alias("b")
    same_place = F.col("a.user_id").eqNullSafe(F.col("b.user_id")) & (F.col(f"a.{PART}") == F.col(f"b.{PART}"))
    differs = ~(F.col("a.n").eqNullSafe(F.col("b.n")) & F.col("a.mark").eqNullSafe(F.col("b.mark")))
    part = F.coalesce(f"a.{PART}", f"b.{PART}")
    user = F.when(F.col("a.n").isNull(), F.col("b.user_id")).otherwise(F.col("a.user_id"))
    found = a.join(b, same_place, "full").where(differs).select(user.alias("user_id"), part.alias("first"))
    return found.groupBy("user_id").agg(F.min("first").alias("first"))


def _reach(changed: DataFrame, now: DataFrame) -> DataFrame:
    """``changed`` with the first part to read (``since``): the one before that of the last rows that windows look back to."""
    c, n = changed.alias("c"), now.alias("n")
    earlier = c.join(n, F.col("c.user_id").eqNullSafe(F.col("n.user_id")) & (F.col(f"n.{PART}") < F.col("c.first")), "left")
    back = Window.partitionBy("c.user_id").orderBy(F.desc(f"n.{PART}"))
    nearer = F.coalesce(F.sum("n.n").over(back.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    needed = earlier.select("c.user_id", "c.first", F.col(f"n.{PART}").alias("part"), nearer.alias("nearer")).where(F.col("nearer") < ROWS_BEFORE)
    return needed.groupBy("user_id", "first").agg((F.coalesce(F.min("part"), F.col("first")) - 1).alias("since"))


def _of(rows: DataFrame, users: DataFrame, bound: str, how: str) -> DataFrame:
    """Rows whose user is in ``users`` and whose part is at the user's bound or later (or the others, for an anti join)."""
    u = users.select(F.col("user_id").alias("__user"), F.col(bound).alias("__bound"))
    return rows.join(u, F.col("user_id").eqNullSafe(F.col("__user")) & (F.col(PART) >= F.col("__bound")), how)


def refresh_load(daily: DataFrame, table: str, unique_days: bool = True) -> dict[str, int]:
    """Bring the mart ``table`` to what ``int_training_load(daily)`` gives, bit for bit; the first call builds it.

    Returns the users that changed, the input rows that were worked on and the parts that were written. Rows without a date count for
    nothing; users without an id are one user. A stop at any step leaves the mart readable, and
    one refresh at a time may write it. The list of parts that reaches the driver is bounded by the calendar.
    """
    spark = daily.sparkSession
    held = _held(spark, table)
    if held is None and spark.catalog.tableExists(table):
        raise ValueError(f"{table} is no mart of this kind")
    rows_at, marks_at = ({}, {}) if held is None else (_places(spark, _name(table, kind, held), PART) for kind in "vk")
    _clean(spark, table, held, {*rows_at.values(), *marks_at.values()})
    days = daily.where(F.col("cycle_date").isNotNull()).withColumn(PART, _part())
    now = stored(_fingerprints(days))
    home = f"{_home(spark, table)}/{uuid.uuid4().hex[:12]}"
    if held is None:
        users = now.select("user_id").distinct().count()
        rows = int_training_load(days, unique_days).withColumn(PART, _part())
        worked, marks = now, now
    else:
        before = spark.table(_name(table, "k", held))
        changed = stored(_reach(stored(_changed(now, before)), now))
        extent = changed.agg(F.count(F.lit(1)).alias("users"), F.min("since").alias("since")).first()
        users = extent.users
        if not users:
            return {"users": 0, "rows_read": 0, "parts_written": 0}
        places = now.select("user_id", PART).union(before.select("user_id", PART))
        touched = sorted(r[0] for r in _of(places, changed, "first", "left_semi").select(PART).distinct().collect())
        # a plain bound on the day, which the scan can use, before the bound of each user
        oldest = F.date_from_unix_date(F.lit(extent.since * (LOOKBACK_DAYS + 1)))
        read = _of(days.where(F.col("cycle_date") >= oldest), changed, "since", "left_semi")
        fresh = _of(int_training_load(read, unique_days).withColumn(PART, _part()), changed, "first", "left_semi")
        old = spark.table(_name(table, "v", held)).where(F.col(PART).isin(touched))
        rows = _of(old, changed, "first", "left_anti").unionByName(fresh)
        worked, marks = _of(now, changed, "since", "left_semi"), now.where(F.col(PART).isin(touched))
        rows_at, marks_at = ({p: at for p, at in places.items() if int(p) not in touched} for places in (rows_at, marks_at))
    attempt = home.rsplit("/", 1)[1]
    written = _written(rows, PART, f"{home}/v")
    _registered(written, PART, _name(table, "v", attempt), f"{home}/v", rows_at)
    _registered(_written(marks, PART, f"{home}/k"), PART, _name(table, "k", attempt), f"{home}/k", marks_at)
    _show(spark, table, attempt, 0)
    parts = written.select(PART).distinct().count()
    return {"users": users, "rows_read": worked.agg(F.sum("n")).first()[0] or 0, "parts_written": parts}


def read_load(spark: SparkSession, table: str) -> DataFrame:
    """Rows of the mart, as ``int_training_load`` gives them."""
    return spark.table(table).drop(PART)
