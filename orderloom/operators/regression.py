"""Regression from sufficient statistics.

One aggregate adds up the products of the features with each other and with the label, so
the rows are read once and never collected or shuffled.  What is left is a system of a few
equations, which is solved in a column expression on one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SMALL = 1e-12  # a feature whose pivot is below this depends on the ones before it


def _terms(features: Sequence[str]) -> list[Column]:
    """Features and a constant as the last."""
    return [F.col(f).cast("double") for f in features] + [F.lit(1.0)]


def _sums(terms: Sequence[Column], weight: Column, target: Column) -> Column:
    """Augmented matrix of the normal equations as an aggregate expression."""
    size = len(terms)
    products = {
        (i, j): F.sum(weight * terms[i] * terms[j]) for i in range(size) for j in range(i, size)
    }
    return F.array(
        *[
            F.array(
                *[products[min(i, j), max(i, j)] for j in range(size)], F.sum(terms[i] * target)
            )
            for i in range(size)
        ]
    )


def solve(matrix: Column, size: int) -> Column:
    """Solution of a symmetric positive system given as ``size`` rows of ``size + 1`` numbers.

    Rows and columns are scaled to a unit diagonal, then eliminated in order.  A feature
    that depends on those before it gets 0.
    """

    def scale(i: Column) -> Column:
        entry = F.get(F.get(matrix, i), i)
        return F.when(entry > 0, F.sqrt(entry)).otherwise(1.0)

    scales = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), scale)

    def scaled(row: Column, i: Column) -> Column:
        return F.transform(
            row, lambda x, j: x / F.get(scales, i) / F.coalesce(F.get(scales, j), F.lit(1.0))
        )

    def eliminate(rows: Column, k: Column) -> Column:
        pivot = F.get(F.get(rows, k), k)
        own = F.transform(
            F.get(rows, k), lambda x: F.when(F.abs(pivot) < SMALL, 0.0).otherwise(x / pivot)
        )
        return F.transform(
            rows,
            lambda row, i: F.when(i == k, own).otherwise(
                F.zip_with(row, own, lambda x, y: x - F.get(row, k) * y)
            ),
        )

    reduced = F.aggregate(
        F.sequence(F.lit(0), F.lit(size - 1)), F.transform(matrix, scaled), eliminate
    )
    return F.transform(reduced, lambda row, i: F.get(row, F.lit(size)) / F.get(scales, i))


def least_squares(rows: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """One row: coefficients (the constant last) and n.

    Rows with a null label or feature take no part; without rows the coefficients are null.
    """
    used = rows.dropna(subset=[*features, label])
    terms = _terms(features)
    sums = used.agg(
        _sums(terms, F.lit(1.0), F.col(label).cast("double")).alias("_m"), F.count("*").alias("n")
    )
    found = solve(F.col("_m"), len(terms))
    return sums.select(F.when(F.col("n") > 0, found).alias("coefficients"), "n")


def linear_score(features: Sequence[str], coefficients: Column) -> Column:
    terms = [t * F.get(coefficients, F.lit(i)) for i, t in enumerate(_terms(features))]
    return sum(terms[1:], terms[0])


def predict(rows: DataFrame, model: DataFrame, features: Sequence[str]) -> DataFrame:
    """The rows with ``prediction``; ``model`` is the one row of ``least_squares``."""
    scored = rows.crossJoin(F.broadcast(model.select(F.col("coefficients").alias("_c"))))
    return scored.withColumn("prediction", linear_score(features, F.col("_c"))).drop("_c")


def logistic(score: Column) -> Column:
    return 1 / (1 + F.exp(-score))


def logistic_regression(
    rows: DataFrame, features: Sequence[str], label: str, steps: int = 8
) -> list[float]:
    """Coefficients (the constant last) after ``steps`` Newton steps from 0.

    Each step is one aggregate over ``rows``, which should be staged; the driver keeps the
    few coefficients between steps.  Rows with a null label or feature take no part.
    """
    used = rows.dropna(subset=[*features, label])
    terms = _terms(features)
    found = [0.0] * len(terms)
    for _ in range(steps):
        proba = logistic(linear_score(features, F.array(*[F.lit(c) for c in found])))
        error = F.col(label).cast("double") - proba
        sums = used.agg(_sums(terms, proba * (1 - proba), error).alias("_m"))
        step = sums.select(solve(F.col("_m"), len(terms)).alias("step")).first()["step"]
        found = [c + (d or 0.0) for c, d in zip(found, step)]
    return found
