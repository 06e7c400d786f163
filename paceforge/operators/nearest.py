"""Nearest-in-time match: an as-of join that looks both ways."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paceforge.operators.running import FIRST, by_slice, carried, carry_window, crossing, sliced, within

_AT, _RIGHT = "__at", "__right"


def nearest_match(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_ts: str,
    right_ts: str,
    right_key: str,
    columns: Mapping[str, str],
    pred: Column | None = None,
    slices: int | None = None,
) -> DataFrame:
    """Give every left row the right row of the same ``on`` group that is nearest in time.

    Left rows without a match keep NULLs. ``columns`` maps right columns to their result names;
    ``pred`` restricts the right side. Nearest means the smallest whole-minute gap. Among equal
    whole minutes the exact gap decides, then the earlier right row, then the smallest
    ``right_key``; the reference leaves such ties open.

    With that order, only two right rows can win: the last one at or before the left row and the
    first one after it. So no pair is ever joined. Both sides are reduced to one row per instant before
    the shuffle and put on one time line per group, which is cut into ``slices`` of its rows (see ``running.sliced``); two
    window passes carry the neighbours along in a slice, and those beyond it come from a row per slice. The winner of each
    instant is then joined back to the left rows, which take no part in the windows.
    """
    keys = list(on)
    matchable = right.where(pred) if pred is not None else right
    payload = F.struct(
        F.col(right_key).alias("__key"),
        *[F.col(source).alias(out) for source, out in columns.items()],
    )
    for name in (*keys, right_ts):
        matchable = matchable.where(F.col(name).isNotNull())
    instants = (
        matchable.groupBy(*keys, F.col(right_ts).alias(_AT))
        .agg(F.min_by(payload, F.col(right_key)).alias("__payload"))
        .select(*keys, _AT, F.struct(F.col(_AT).alias("__time"), "__payload").alias(_RIGHT))
    )
    asked = left.select(*keys, F.col(left_ts).alias(_AT)).where(F.col(_AT).isNotNull()).distinct()
    there = F.col(_RIGHT).isNull()
    line = sliced(asked.unionByName(instants, allowMissingColumns=True), keys, [F.asc(_AT), there.asc()], slices)

    # At one instant the right row comes first in both directions. Both passes use a growing frame: one that
    # shrinks towards the end of the partition is evaluated anew for every row.
    forward = within(keys, [F.asc(_AT), there.asc()]).rowsBetween(FIRST, 0)
    backward = within(keys, [F.desc(_AT), there.asc()]).rowsBetween(FIRST, 0)
    local = by_slice(line).select(
        "*",
        F.last(_RIGHT, ignorenulls=True).over(forward).alias("__here_before"),
        F.last(_RIGHT, ignorenulls=True).over(backward).alias("__here_after"),
    )
    time = F.when(~there, F.col(_AT))
    ends = crossing(line, keys, F.max_by(_RIGHT, time).alias("__last"), F.min_by(_RIGHT, time).alias("__first"))
    edges = ends.select(
        *[c for c in ends.columns if c not in ("__last", "__first")],
        F.last("__last", ignorenulls=True).over(carry_window(keys).rowsBetween(FIRST, -1)).alias("__edge_before"),
        F.last("__first", ignorenulls=True).over(carry_window(keys, descending=True).rowsBetween(FIRST, -1)).alias("__edge_after"),
    )
    matched = carried(local.where(there), edges, keys).select(
        *keys,
        _AT,
        F.coalesce("__here_before", "__edge_before").alias("__before"),
        F.coalesce("__here_after", "__edge_after").alias("__after"),
    )

    gap_before = F.unix_micros(F.col(_AT)) - F.unix_micros(F.col("__before.__time"))
    gap_after = F.unix_micros(F.col("__after.__time")) - F.unix_micros(F.col(_AT))
    nearest = (
        F.when(F.col("__before").isNull(), F.col("__after"))
        .when(F.col("__after").isNull() | (gap_before <= gap_after), F.col("__before"))
        .otherwise(F.col("__after"))
    )
    picked = matched.select(
        *[F.col(key).alias(f"__on_{key}") for key in keys], F.col(_AT).alias("__on_at"), nearest["__payload"].alias("__payload")
    )
    same = F.col(left_ts) == F.col("__on_at")
    for key in keys:
        same = same & (F.col(key) == F.col(f"__on_{key}"))
    return left.join(picked, same, "left").select(*left.columns, *[F.col(f"__payload.{out}") for out in columns.values()])

