"""One row per key: latest version, longest sleep, and other best-of-key picks.

The filter on ``row_number() = 1`` lets Spark place a group limit before the shuffle: each task
sends on at most one row per key, so a key that holds a large part of the log costs no more than
any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def best_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of every key in the given order, which should leave no ties."""
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn(_RANK, F.row_number().over(window))
    return ranked.where(F.col(_RANK) == 1).drop(_RANK)


def latest_version(
    df: DataFrame, keys: Sequence[str], order: str = "loaded_at", tiebreak: Sequence[Column] | None = None
) -> DataFrame:
    """Most recently loaded row of every key; a NULL load time is the oldest.

    The reference leaves rows of one key and load time to chance. Here a tie falls to a hash of the
    whole row, the same on every run and in every branch of a plan. That reads all columns; where
    other columns settle the order, give them as ``tiebreak`` instead.
    """
    ties = [F.xxhash64(*df.columns)] if tiebreak is None else tiebreak
    return best_row(df, keys, [F.col(order).desc_nulls_last(), *ties])


def longest_sleep(sleeps: DataFrame, key: str = "cycle_id", hours: str = "in_bed_hours") -> DataFrame:
    """Longest sleep of every cycle, unknown hours as zero; ties to the lowest ``sleep_id``."""
    return best_row(sleeps, [key], [F.coalesce(F.col(hours), F.lit(0.0)).desc(), F.col("sleep_id")])
