"""Running totals, previous rows and positions over groups of any size.

The rows are range-partitioned by group and order and stored, so every partition is one stretch of the whole order. These
slices follow the rows themselves, as Spark samples them: a group with a third of all rows takes a third of the slices, be its ids sparse or all of
its rows in one hour. Inside a slice plain windows run, without a further shuffle of what a slice holds. Only the first and the last
group of a slice can go on in another one, so what slices hand on is a table of two rows for each slice at most, which is broadcast. Sums
are of whole numbers, so that no cut can change a bit of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from paceforge.storage import stored

SLICE = "__slice"
FIRST, LAST = Window.unboundedPreceding, Window.unboundedFollowing


def sliced(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], slices: int | None = None) -> DataFrame:
    """``df``, stored, with the slice of each row in ``SLICE``; slices rise with the keys and then with the order.

    The order goes down to a key: rows that are equal in it can't be told apart and lie in one slice. ``slices`` is their number, by default
    that of shuffle partitions.
    """
    by = [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in (*keys, *order)]
    return stored(df.repartitionByRange(slices or _partitions(df), *by).withColumn(SLICE, F.spark_partition_id()))


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def by_slice(df: DataFrame) -> DataFrame:
    """The rows with a partition for each slice: windows within slices need no other shuffle."""
    return df.repartitionById(_partitions(df), F.col(SLICE))


def crossing(df: DataFrame, keys: Sequence[str], *figures: Column) -> DataFrame:
    """``figures`` of each slice and group that may go on in another slice: the first and the last group of a slice.

    Key columns are named ``__carry_<key>`` and the slice ``__carry_slice``, for ``carried``.
    """
    group = F.struct(*[F.col(key) for key in keys]) if keys else F.lit(0)
    ends = df.groupBy(SLICE).agg(F.min(group).alias("__low"), F.max(group).alias("__high"))
    edge = df.join(F.broadcast(ends), SLICE).where(group.eqNullSafe(F.col("__low")) | group.eqNullSafe(F.col("__high")))
    names = [F.col(key).alias(f"__carry_{key}") for key in keys]
    return edge.groupBy(F.col(SLICE).alias("__carry_slice"), *names).agg(*figures)


def carry_window(keys: Sequence[str], descending: bool = False) -> WindowSpec:
    """The slices of a group in order; it runs over two rows for each slice at most."""
    at = F.col("__carry_slice")
    return Window.partitionBy(*([f"__carry_{key}" for key in keys] or [F.lit(0)])).orderBy(at.desc() if descending else at.asc())


def carried(df: DataFrame, carry: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with what its groups carry into their slices, NULL for a group that lies in one slice."""
    same = F.col(SLICE) == F.col("__carry_slice")
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"__carry_{key}"))
    return df.join(F.broadcast(carry), same, "left").drop("__carry_slice", *[f"__carry_{key}" for key in keys])


def within(keys: Sequence[str], order: Sequence[str | Column]) -> WindowSpec:
    return Window.partitionBy(SLICE, *keys).orderBy(*order)


def previous_row(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], out: str
) -> DataFrame:
    """Add the struct ``out`` of ``columns`` of the previous row of the group, NULL on the first.

    ``df`` is ``sliced``.
    """
    here = F.struct(*columns)
    local = by_slice(df).withColumn(out, F.lag(here).over(within(keys, order)))
    ends = crossing(df, keys, F.max_by(here, F.struct(*order)).alias("__end"))
    carry = ends.withColumn("__carried", F.lag("__end").over(carry_window(keys))).drop("__end")
    return carried(local, carry, keys).withColumn(out, F.coalesce(out, "__carried")).drop("__carried")


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    before: str,
    after: str,
    total: str,
    is_last: str,
    placed: bool = False,
) -> DataFrame:
    """Add the sum of ``value``, a whole number, ahead of each row, with the row, and over the whole group.

    ``is_last`` marks the last row of each group. ``df`` is ``sliced``; ``placed`` if it has its rows by slice already, as
    ``previous_row`` leaves them.
    """
    in_order = within(keys, order)
    local = (df if placed else by_slice(df)).select(
        "*",
        F.sum(value).over(in_order.rowsBetween(FIRST, 0)).alias("__here"),
        F.sum(value).over(in_order.rowsBetween(FIRST, LAST)).alias("__slice_total"),
        F.lead(F.lit(True)).over(in_order).isNull().alias("__ends"),
    )
    slices = carry_window(keys)
    carry = crossing(df, keys, F.sum(value).alias("__sum")).select(
        "*",
        F.sum("__sum").over(slices.rowsBetween(FIRST, -1)).alias("__earlier"),
        F.sum("__sum").over(slices.rowsBetween(FIRST, LAST)).alias("__all"),
        F.lead(F.lit(True)).over(slices).isNull().alias("__last_slice"),
    )
    return (
        carried(local, carry.drop("__sum"), keys)
        .withColumn(after, F.coalesce("__earlier", F.lit(0)) + F.col("__here"))
        .withColumn(before, F.col(after) - F.col(value))
        .withColumn(total, F.coalesce("__all", "__slice_total"))
        .withColumn(is_last, F.col("__ends") & F.coalesce("__last_slice", F.lit(True)))
        .drop("__here", "__ends", "__earlier", "__last_slice", "__all", "__slice_total")
    )


def positions(
    df: DataFrame, order: Sequence[Column], out: str = "position", start: int = 1, slices: int | None = None, last: tuple[str, Column] | None = None
) -> DataFrame:
    """Add the place of each row in the order of the whole table, as ``orderBy`` and a row number would give it.

    The rows of each slice are numbered by themselves, and the numbers of rows of the slices, added up, come on top. ``last`` is the name and
    the expression of a column that ends the order and is added too; it is worked out behind the shuffles, which don't carry it.
    """
    name, made = last or (None, None)
    cut = sliced(df, [], [*order, *([F.asc(made)] if name else [])], slices)
    rows, down = (by_slice(cut).withColumn(name, made), [*order, F.asc(name)]) if name else (by_slice(cut), order)
    own = rows.withColumn("__own", F.row_number().over(Window.partitionBy(SLICE).orderBy(*down)))
    counts = cut.groupBy(F.col(SLICE).alias("__carry_slice")).agg(F.count(F.lit(1)).alias("__rows"))
    ahead = F.coalesce(F.sum("__rows").over(carry_window([]).rowsBetween(FIRST, -1)), F.lit(0))
    numbered = carried(own, counts.select("__carry_slice", ahead.alias("__ahead")), [])
    return numbered.select(*df.columns, *([name] if name else []), (F.col("__ahead") + F.col("__own") + (start - 1)).cast("bigint").alias(out))


def as_ordered(df: DataFrame, out: str = "position") -> DataFrame:
    """Add the place of each row in the order that ``df`` gives its rows in, such as an ``orderBy`` leaves."""
    return positions(df.withColumn("__at", F.monotonically_increasing_id()), [F.asc("__at")], out).drop("__at")
