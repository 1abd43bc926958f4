from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderloom.functions.significance import with_p_value
from orderloom.operators.regression import (
    least_squares,
    linear_score,
    logistic,
    logistic_regression,
    predict,
)


@pytest.fixture(scope="module")
def made(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1000, 3)) * [1, 50, 0.01] + [5, 0, 1]
    y = x @ [2.0, -0.1, 30.0] + 4 + rng.normal(size=1000)
    chance = 1 / (1 + np.exp(-(x @ [0.5, 0.02, 20.0] - 22)))
    hit = (rng.random(1000) < chance).astype(int)
    rows = [(*map(float, a), float(b), int(c)) for a, b, c in zip(x, y, hit)]
    frame = spark.createDataFrame(rows, "a double, b double, c double, y double, hit int")
    return x, y, hit, frame.repartition(5)


def test_least_squares(made):
    x, y, _, frame = made
    want = np.linalg.lstsq(np.c_[x, np.ones(1000)], y, rcond=None)[0]
    row = least_squares(frame, ["a", "b", "c"], "y").first()
    assert row["n"] == 1000 and row["coefficients"] == pytest.approx(list(want), rel=1e-8)


def test_dependent_features_and_nulls(spark, made):
    x, y, _, frame = made
    want = np.linalg.lstsq(np.c_[x, np.ones(1000)], y, rcond=None)[0]
    twice = frame.withColumn("a2", F.col("a") * 2).withColumn("none", F.lit(0))
    gaps = twice.unionAll(twice.limit(5).withColumn("b", F.lit(None).cast("double")))
    row = least_squares(gaps, ["a", "a2", "b", "c", "none"], "y").first()
    a, a2, b, c, none, constant = row["coefficients"]
    assert row["n"] == 1000 and (a2, none) == (0.0, 0.0)
    assert [a, b, c, constant] == pytest.approx(list(want), rel=1e-7)


def test_no_rows(spark):
    empty = spark.createDataFrame([], "a double, y double")
    assert least_squares(empty, ["a"], "y").first()["coefficients"] is None
    assert logistic_regression(empty, ["a"], "y") == [0.0, 0.0]


def test_predict(spark):
    frame = spark.createDataFrame([(float(i), 3.0 * i + 1) for i in range(10)], "a double, y double")
    model = least_squares(frame, ["a"], "y")
    for row in predict(frame, model, ["a"]).collect():
        assert row["prediction"] == pytest.approx(row["y"])


def test_logistic_regression_matches_newton(made):
    x, _, hit, frame = made
    design, want = np.c_[x, np.ones(1000)], np.zeros(4)
    for _ in range(8):
        p = 1 / (1 + np.exp(-design @ want))
        want = want + np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design, design.T @ (hit - p))
    found = logistic_regression(frame, ["a", "b", "c"], "hit")
    assert found == pytest.approx(list(want), rel=1e-7)
    score = linear_score(["a", "b", "c"], F.array(*[F.lit(c) for c in found]))
    mean = frame.agg(F.avg(logistic(score)), F.avg("hit")).first()
    assert mean[0] == pytest.approx(mean[1])  # holds at the maximum


def log10_p(spark, pairs):
    frame = spark.createDataFrame(pairs, "rho double, n long")
    return [r for r in with_p_value(frame).collect()]


def test_p_values_with_closed_forms(spark):
    rhos = [-0.99, -0.5, 1e-3, 0.2, 0.9, 0.99999]
    for r in log10_p(spark, [(rho, 3) for rho in rhos]):  # one degree of freedom: Cauchy
        assert r["p_value"] == pytest.approx(2 / math.pi * math.acos(abs(r["rho"])), rel=1e-10)
    for r in log10_p(spark, [(rho, 4) for rho in rhos]):  # two degrees of freedom
        assert r["p_value"] == pytest.approx(1 - abs(r["rho"]), rel=1e-10)
    for r in log10_p(spark, [(rho, 6) for rho in rhos]):  # four
        rho = abs(r["rho"])
        assert r["p_value"] == pytest.approx((1 - rho) ** 2 * (2 + rho) / 2, rel=1e-9)


def series(rho: float, n: int) -> float:
    """log10 of p by the power series, with exact fractions of the coefficients."""
    a, x = (n - 2) / 2, 1 - rho * rho
    term, total, k = 1.0, 1.0, 0
    while term > total * 1e-17:
        term *= (a + 0.5 + k) / (a + 1 + k) * x
        total += term
        k += 1
    beta = math.lgamma(a) + math.lgamma(0.5) - math.lgamma(a + 0.5)
    return (a * math.log(x) + 0.5 * math.log(1 - x) - math.log(a) - beta + math.log(total)) / math.log(10)


def test_tails_are_not_rounded_to_nothing(spark):
    pairs = [(0.404522, 1500), (0.850135, 1500), (0.1, 50), (0.3, 200_000), (-0.05, 1000)]
    for r in log10_p(spark, pairs):
        assert r["log10_p"] == pytest.approx(series(r["rho"], r["n"]), rel=1e-9)
    assert log10_p(spark, [(0.404522, 1500)])[0]["p_value"] < 1e-50


def test_p_value_edges(spark):
    got = {(r["rho"], r["n"]): r["p_value"] for r in log10_p(spark, [(0.0, 9), (1.0, 9), (-1.0, 9), (0.5, 2)])}
    assert got == {(0.0, 9): 1.0, (1.0, 9): 0.0, (-1.0, 9): 0.0, (0.5, 2): None}
