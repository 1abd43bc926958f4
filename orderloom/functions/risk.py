"""Proportions: smoothing, confidence bounds, risk classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Z_95 = 1.96
Z_95_EXACT = 1.959963984540054


def smoothed(successes: Column, trials: Column, alpha: float) -> Column:
    return (successes + F.lit(alpha)) / (trials + F.lit(2 * alpha))


def wilson_bounds(p: Column, n: Column, z: float = Z_95) -> tuple[Column, Column]:
    """Lower and upper Wilson score bounds of a proportion; no trials give (0, 0)."""
    z2 = F.lit(z * z)
    n = n.cast("double")
    centre = 2 * n * p + z2
    spread = F.lit(z) * F.sqrt(F.greatest(4 * n * p * (1 - p) + z2, F.lit(0.0)))
    scale = 2 * (n + z2)
    empty = n == 0
    lower = F.when(empty, 0.0).otherwise((centre - spread) / scale)
    upper = F.when(empty, 0.0).otherwise((centre + spread) / scale)
    return lower, upper


def risk_class(lower: Column, upper: Column, pivot: Column) -> Column:
    return F.when(lower > pivot, "Low").when(upper < pivot, "High").otherwise("Moderate")


def compounding_repeats(start: Column, rate: Column) -> Column:
    """Repeat purchases a batch of orders leads to in all.

    Every round keeps ``floor(batch * rate)`` orders until none is left; the first batch
    is not counted.  A batch of n is empty after at most ln n / -ln rate rounds, so the
    loop length is known per row.  A rate of 0 gives 0, a rate of 1 or more null.
    """
    start = start.cast("long")
    rounds = F.ceil(F.ln(F.greatest(start, F.lit(1))) / -F.ln(rate)) + 1
    batch = F.struct(start.alias("live"), F.lit(0).cast("long").alias("total"))

    def step(acc: Column, _: Column) -> Column:
        live = F.floor(acc["live"] * rate).cast("long")
        return F.struct(live.alias("live"), (acc["total"] + live).alias("total"))

    walked = F.aggregate(F.sequence(F.lit(1).cast("long"), rounds), batch, step)["total"]
    return F.when((start < 1) | (rate <= 0), F.lit(0).cast("long")).when(rate < 1, walked)
