"""Left joins between activities and days, and the anti join for missing keys."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def attach_day(
    activities: DataFrame,
    daily: DataFrame,
    columns: Mapping[str, str],
    activity_date: str,
    day: str = "cycle_date",
    offset: int = 0,
    user_col: str | None = None,
) -> DataFrame:
    """Left-join every activity to the day ``offset`` days after it.

    ``columns`` maps columns of ``daily`` to their names in the result, and ``user_col`` names the owner
    column that both sides share. Without it the join is on the date only, which is right for the data of one
    user; a date with more than one day is then an error, as every activity would meet the days of all users.
    Days with very many activities are left to adaptive execution, which splits skewed joins.
    """
    users = [user_col] if user_col else []
    days = daily.where(F.col(day).isNotNull()).select(
        *users,
        F.col(day).alias("__day"),
        *[F.col(source).alias(out) for source, out in columns.items()],
    )
    if not users:
        days = _one_per_day(days, list(columns.values()))
    dated = activities.withColumn("__day", F.date_add(F.col(activity_date), offset))
    return dated.join(days, [*users, "__day"], "left").select(*activities.columns, *columns.values())


def attach_days(
    activities: DataFrame,
    daily: DataFrame,
    columns: Mapping[int, Mapping[str, str]],
    activity_date: str,
    day: str = "cycle_date",
    user_col: str | None = None,
) -> DataFrame:
    """What ``attach_day`` gives for several offsets, each with its own ``columns``, by one look-up.

    Every day is sent to the dates that see it, which needs ``daily`` once, and the days of one date meet in one row before the join. With
    ``user_col`` a user's date may have more than one day, and every activity then meets each of them, as a join would have it.
    """
    users = [user_col] if user_col else []
    needed = sorted({source for names in columns.values() for source in names})
    seen = F.explode(F.array(*[F.struct(F.date_sub(F.col(day), offset).alias("__day"), F.lit(offset).alias("__offset")) for offset in columns]))
    moved = daily.where(F.col(day).isNotNull()).select(*users, seen.alias("__seen"), F.struct(*needed).alias("__row"))
    moved = moved.select(*users, "__seen.*", "__row")

    def rows(offset: int) -> Column:
        mine = F.when(F.col("__offset") == offset, F.col("__row"))
        if users:
            return F.collect_list(mine).alias(f"__rows_{offset}")
        message = F.concat(F.lit("more than one day on "), F.date_add("__day", offset).cast("string"), F.lit("; name the owner column"))
        one = F.when(F.count(mine) > 1, F.raise_error(message).cast(moved.schema["__row"].dataType)).otherwise(F.first(mine, ignorenulls=True))
        return F.array(one).alias(f"__rows_{offset}")

    by_date = moved.groupBy(*users, "__day").agg(*[rows(offset) for offset in columns])
    joined = activities.withColumn("__day", F.col(activity_date)).join(by_date, [*users, "__day"], "left")
    for offset in columns:
        joined = joined.withColumn(f"__rows_{offset}", F.explode_outer(f"__rows_{offset}"))
    shown = [F.col(f"__rows_{offset}.{source}").alias(out) for offset, names in columns.items() for source, out in names.items()]
    return joined.select(*activities.columns, *shown)


def _one_per_day(days: DataFrame, columns: list[str]) -> DataFrame:
    """The days as they are, if each date has one; an error when the query runs, if not."""
    counted = days.groupBy("__day").agg(F.count(F.lit(1)).alias("__n"), *[F.first(c).alias(c) for c in columns])
    message = F.concat(F.lit("more than one day on "), F.col("__day").cast("string"), F.lit("; name the owner column"))
    day = F.when(F.col("__n") > 1, F.raise_error(message).cast("date")).otherwise(F.col("__day"))
    return counted.select(day.alias("__day"), *columns)


def attach_one(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join on a key that is unique on both sides, such as a deduplicated identifier."""
    return left.join(right, key, "left")


def missing_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``left`` that ``right`` lacks, in order.

    Both sides are made distinct first: repeated keys are dropped before the shuffle, and the join
    then runs on the partitioning that the distinct left behind.
    """
    wanted = left.select(key).distinct()
    present = right.select(key).where(F.col(key).isNotNull()).distinct()
    return wanted.join(present, key, "left_anti").orderBy(key)
