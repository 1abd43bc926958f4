"""Student's t distribution as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The series of ln(gamma(a + 1/2) / gamma(a)) - ln(a) / 2 in odd powers of 1/a.
_SERIES = [(-1, 8), (1, 192), (-1, 640), (17, 14336), (-31, 18432)]
_SHIFT = 12


def _log_gamma_ratio(a: Column) -> Column:
    """ln(gamma(a + 1/2) / gamma(a)) for a > 0: moved up to where the series is exact."""
    far = a + _SHIFT
    value = F.log(far) / 2
    for power, (above, below) in enumerate(_SERIES):
        value = value + F.lit(above / below) / F.pow(far, F.lit(2 * power + 1.0))
    for i in range(_SHIFT):
        value = value + F.log((a + i) / (a + i + 0.5))
    return value


def _fraction(a: Column, b: Column, x: Column) -> Column:
    """Continued fraction of the incomplete beta function, from the front (Lentz)."""
    tiny = F.lit(1e-300)

    def held(value: Column) -> Column:
        return F.when(F.abs(value) < tiny, tiny).otherwise(value)

    def step(state: Column, above: Column) -> Column:
        # c and d are the ratios of successive numerators and denominators
        d = 1 / held(1 + above * state["d"])
        c = held(1 + above / state["c"])
        return F.struct(c.alias("c"), d.alias("d"), (state["h"] * c * d).alias("h"))

    def pair(state: Column, m: Column) -> Column:
        m = m.cast("double")
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        return step(step(state, even), odd)

    first = 1 / held(1 - (a + b) * x / (a + 1))
    start = F.struct(F.lit(1.0).alias("c"), first.alias("d"), first.alias("h"))
    rounds = F.least(F.lit(60) + 4 * F.sqrt(F.greatest(a, b)), F.lit(200_000)).cast("int")
    return F.aggregate(F.sequence(F.lit(1), rounds), start, pair)["h"]


def log_p_of_correlation(rho: Column, n: Column) -> Column:
    """Natural logarithm of the two-sided p-value of a correlation of n pairs.

    That of t = rho * sqrt((n - 2) / (1 - rho^2)) with n - 2 degrees of freedom, which is
    the regularised incomplete beta function at 1 - rho^2.  Null for fewer than 3 pairs,
    minus infinity for a correlation of 1 or -1.
    """
    a, half = (n.cast("double") - 2) / 2, F.lit(0.5)
    x, y = (1 - rho) * (1 + rho), rho * rho
    log_beta = F.lit(math.log(math.pi) / 2) - _log_gamma_ratio(a)
    front = a * F.log(x) + F.log(F.abs(rho)) - log_beta
    direct = front - F.log(a) + F.log(_fraction(a, half, x))
    other = F.log1p(-F.exp(front) * 2 * _fraction(half, a, y))
    quick = x < (a + 1) / (a + 2.5)
    value = (
        F.when(rho == 0, F.lit(0.0))
        .when(x <= 0, F.lit(float("-inf")))
        .when(quick, direct)
        .otherwise(other)
    )
    return F.when(n > 2, value)


def with_p_value(correlations, rho: str = "rho", n: str = "n"):
    """Add ``p_value`` and ``log10_p``; the latter also where the former is below 1e-308."""
    log_p = log_p_of_correlation(F.col(rho), F.col(n))
    return correlations.withColumn("_log_p", log_p).select(
        *correlations.columns,
        F.exp("_log_p").alias("p_value"),
        (F.col("_log_p") / math.log(10)).alias("log10_p"),
    )
