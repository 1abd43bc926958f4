"""Skewness and power transforms as aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FLOOR = 1e-6


def positive(value: Column) -> Column:
    """Clip to a small positive number, so logs and powers exist."""
    return F.greatest(value.cast("double"), F.lit(FLOOR))


def sample_skewness(value: Column) -> Column:
    """Bias-corrected skewness; fewer than three rows give null."""
    n = F.count(value)
    corrected = F.skewness(value) * F.sqrt(n * (n - 1)) / (n - 2)
    return F.when(n > 2, corrected)


def boxcox(value: Column, lam: Column | float) -> Column:
    lam = F.lit(float(lam)) if isinstance(lam, (int, float)) else lam
    near_zero = F.abs(lam) < 1e-12
    return F.when(near_zero, F.ln(value)).otherwise((F.pow(value, lam) - 1) / lam)


def boxcox_likelihood(df: DataFrame, grids: Mapping[str, Sequence[float]]) -> DataFrame:
    """Log-likelihood per column and lambda: rows (metric, lam, llf).

    Every row is repeated per candidate and combined again before the shuffle, which
    moves one row per candidate and task.
    """
    entries = [
        F.struct(
            F.lit(name).alias("metric"),
            positive(F.col(name)).alias("x"),
            F.array(*[F.lit(float(v)) for v in grid]).alias("grid"),
        )
        for name, grid in grids.items()
    ]
    rows = df.select(F.inline(F.array(*entries))).select(
        "metric", "x", F.ln("x").alias("log_x"), F.explode("grid").alias("lam")
    )
    # the variance does not need the shift by -1 / lambda, which would cancel digits
    power = F.when(F.col("lam") == 0, F.col("log_x")).otherwise(F.pow("x", "lam") / F.col("lam"))
    stats = rows.groupBy("metric", "lam").agg(
        F.var_pop(power).alias("v"), F.sum("log_x").alias("logs"), F.count("*").alias("n")
    )
    llf = (F.col("lam") - 1) * F.col("logs") - F.col("n") / 2 * F.ln("v")
    return stats.select("metric", "lam", llf.alias("llf"))


def best_lambdas(df: DataFrame, columns: Sequence[str], rounds: int = 4) -> dict[str, float]:
    """The lambda of greatest likelihood in [-2, 2] per column, to about four digits.

    Each round is one aggregation over 41 candidates per column; one row per column
    comes back.
    """
    spans = {name: (-2.0, 2.0) for name in columns}
    found = {name: 1.0 for name in columns}
    for _ in range(rounds):
        grids = {
            name: [low + i * (high - low) / 40 for i in range(41)]
            for name, (low, high) in spans.items()
        }
        top = (
            boxcox_likelihood(df, grids)
            .where(F.col("llf").isNotNull())
            .groupBy("metric")
            .agg(F.max_by("lam", F.struct("llf", -F.col("lam"))).alias("lam"))
        )
        for row in top.collect():
            low, high = spans[row["metric"]]
            step = (high - low) / 40
            found[row["metric"]] = row["lam"]
            spans[row["metric"]] = (max(row["lam"] - step, -2.0), min(row["lam"] + step, 2.0))
    return found


def skewness_report(df: DataFrame, columns: Sequence[str], lambdas: dict[str, float] | None = None) -> DataFrame:
    """Skewness of each column as it is, in logs, in roots and after its power transform."""
    lambdas = lambdas or {}
    aggregates, entries = [], []
    for i, name in enumerate(columns):
        x = positive(F.col(name))
        forms = {"raw": x, "log": F.ln(x), "sqrt": F.sqrt(x), "cbrt": F.cbrt(x)}
        if name in lambdas:
            forms["boxcox"] = boxcox(x, lambdas[name])
        for form, value in forms.items():
            out = f"s_{i}_{form}"
            aggregates.append(sample_skewness(value).alias(out))
            entries.append(
                F.struct(
                    F.lit(name).alias("metric"),
                    F.lit(form).alias("transform"),
                    F.col(out).alias("skewness"),
                )
            )
    return df.agg(*aggregates).select(F.inline(F.array(*entries)))
