"""Exponentially decayed training load over a capped look-back."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values.
CTL_DAYS = 42
ATL_DAYS = 7
LOOKBACK_DAYS = 180


def ewma_load(
    df: DataFrame,
    value: str,
    user: str = "user_id",
    day: str = "cycle_date",
    taus: Mapping[str, float] | None = None,
    cap: int = LOOKBACK_DAYS,
    digits: int | None = 1,
) -> DataFrame:
    """Add, for each time constant T, the sum of ``value * (1 - a) * a^age`` with a = exp(-1/T).

    ``day`` is a date or the number of a day. The sum runs over the days up to the current one, at
    most ``cap`` days back. Summing every look-back anew costs ``cap`` steps per row; this takes a
    few steps per row, whatever the cap.

    Time is cut in blocks of ``cap + 1`` days, and each value is scaled by exp(place / T) with its
    place in its block, so that one running sum per block serves all its days. A look-back that ends
    in a block starts in the block before, and lacks of it just the days up to the same place: it is
    the running sum here, plus the whole sum of the block before, less the running sum there at the
    last day that is too old. All three are faded to the current day. Scaled values stay below
    exp(cap / T) times the value, and what the difference cancels has faded by that factor, so the
    error stays at the last bits of the largest value. An array of the look-back is never built.
    """
    taus = taus or {"ctl": CTL_DAYS, "atl": ATL_DAYS}
    span = cap + 1
    if any(2 * span / tau > 700 for tau in taus.values()):
        raise ValueError("look-back too long for the time constant")

    numbered, number = df, day
    if dict(df.dtypes)[day] == "date":
        numbered, number = df.withColumn("__number", F.unix_date(F.col(day))), "__number"
    place = F.pmod(F.col(number), F.lit(span))
    numbered = numbered.withColumn("__block", F.floor(F.col(number) / F.lit(span)))

    # The first window is per user, and so are the rows of all later ones: one shuffle serves them.
    # Blocks follow the days, so these windows also share one sort.
    by_user = Window.partitionBy(user).orderBy("__block", number)
    in_block = Window.partitionBy(user, "__block").orderBy(number)
    so_far = in_block.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    sums = {
        name: F.sum(F.col(value) * F.exp(place / F.lit(float(tau)))).over(so_far)
        for name, tau in taus.items()
    }
    running = F.struct(
        F.col("__block").alias("block"),
        F.count(value).over(so_far).alias("days"),
        *[F.coalesce(total, F.lit(0.0)).alias(name) for name, total in sums.items()],
    )
    opens_block = F.col("__block_before") < F.col("__block")
    blocked = (
        numbered.withColumn("__block_before", F.lag("__block").over(by_user))
        .withColumn("__here", running)
        .withColumn("__opened", F.when(opens_block, F.lag("__here").over(by_user)))
        .withColumn("__whole", F.first("__opened", ignorenulls=True).over(so_far))
    )
    too_old = Window.partitionBy(user).orderBy(number).rangeBetween(Window.unboundedPreceding, -span)
    aged = blocked.withColumn("__old", F.last("__here").over(too_old))

    def earlier(field: str) -> Column:
        """What the look-back takes from the block before."""
        is_next = F.col("__whole.block") == F.col("__block") - 1
        is_cut = F.col("__old.block") == F.col("__block") - 1
        cut = F.when(is_cut, F.col(f"__old.{field}")).otherwise(F.lit(0))
        return F.when(is_next, F.col(f"__whole.{field}") - cut).otherwise(F.lit(0))

    found = F.col("__here.days") + earlier("days") > 0

    def decayed(name: str, tau: float) -> Column:
        here = F.col(f"__here.{name}") + earlier(name) * F.lit(math.exp(-span / tau))
        faded = here * F.exp(-place / F.lit(float(tau))) * F.lit(1.0 - math.exp(-1.0 / tau))
        known = F.when(F.col(user).isNotNull() & found, faded)
        return known if digits is None else F.round(known, digits)

    return aged.select(*df.columns, *[decayed(name, tau).alias(name) for name, tau in taus.items()])
