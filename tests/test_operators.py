from __future__ import annotations

import random
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from orderloom.operators import ordering, profile, quality, sampling, transforms
from orderloom.operators.neighbours import with_next
from orderloom.plans import rfm


@pytest.fixture(scope="module")
def skewed(spark):
    """One customer with a third of all rows, many with a few, repeated values."""
    rng = random.Random(5)
    rows = []
    for i in range(900):
        customer = 1 if i % 3 == 0 else rng.randint(2, 60)
        when = datetime(2023, 1, 1) + timedelta(minutes=rng.randint(0, 60 * 24 * 40))
        rows.append((i, customer, when, rng.choice([1.0, 1.0, 2.5, 7.0]) * rng.randint(1, 9)))
    return spark.createDataFrame(rows, "id long, customer_id long, ts timestamp_ntz, v double").cache()


def test_next_is_a_plain_lead(spark, skewed):
    """Null times, null keys, equal times, and a customer with a third of the rows in a day."""
    day = datetime(2023, 5, 1)
    odd = [(1000 + i, None if i % 4 == 0 else 2, None if i % 3 == 0 else day, 1.0) for i in range(40)]
    odd += [(2000 + i, 99, day + timedelta(seconds=i // 7), 1.0) for i in range(500)]
    rows = skewed.unionAll(spark.createDataFrame(odd, skewed.schema))
    plain = Window.partitionBy("customer_id").orderBy("ts", "id")
    want = rows.withColumn("n", F.lead("ts").over(plain)).select("id", "n")
    got = with_next(rows.repartition(7), "customer_id", ["ts", "id"], "n")
    assert got.columns == [*rows.columns, "n"]
    assert sorted(map(str, got.select("id", "n").collect())) == sorted(map(str, want.collect()))


def test_next_of_no_rows(skewed):
    assert with_next(skewed.where("false"), "customer_id", ["ts", "id"], "n").collect() == []


def test_row_numbers(skewed):
    got = ordering.with_row_number(skewed.select("id", "v"), ["v", "id"], "rn").toPandas()
    want = skewed.select("id", "v").toPandas().sort_values(["v", "id"]).reset_index(drop=True)
    got = got.sort_values("rn").reset_index(drop=True)
    assert got["rn"].tolist() == list(range(1, 901))
    assert got["id"].tolist() == want["id"].tolist()


def test_prefix_sums_in_falling_order(skewed):
    got = ordering.with_prefix(skewed.select("id"), [F.col("id").desc()], {"s": "id"}).toPandas()
    got = got.sort_values("id", ascending=False)
    assert got["s"].tolist() == [0, *np.cumsum(got["id"])[:-1]]


def test_quantiles(skewed):
    values = skewed.select("v").toPandas()["v"]
    points = {"a": 0.0, "b": 0.1, "c": 0.25, "d": 0.5, "e": 0.9, "f": 1.0}
    ids = {"g": 0.35}
    row = ordering.exact_quantiles(skewed, {"v": points, "id": ids}).first()
    for name, p in points.items():
        assert row[name] == pytest.approx(values.quantile(p))
    assert row["g"] == pytest.approx(899 * 0.35)


def test_average_ranks(skewed):
    values = skewed.select("v").toPandas()["v"]
    want = dict(zip(values, values.rank()))
    got = {r["value"]: r["rank"] for r in ordering.average_ranks(skewed, ["v"]).collect()}
    assert got == want


def test_spearman_and_significance(skewed):
    frame = skewed.withColumn("w", F.col("v") * 2 + F.col("id") % 5)
    row = ordering.significance(ordering.spearman(frame, ["v", "w"])).first()
    pdf = frame.select("v", "w").toPandas()
    rho = pdf["v"].rank().corr(pdf["w"].rank())
    assert row["rho"] == pytest.approx(rho) and row["n"] == 900
    assert row["t_stat"] == pytest.approx(rho * np.sqrt(898 / (1 - rho**2))) and row["significant"]


def test_roc(spark):
    rows = [(0.9, 1), (0.8, 0), (0.8, 1), (0.3, 0), (0.1, 1), (0.1, 0)]
    frame = spark.createDataFrame(rows, "proba double, churn int")
    points = {r["threshold"]: (r["fpr"], r["tpr"]) for r in ordering.roc_points(frame, "proba", "churn").collect()}
    assert points == {
        0.9: (0.0, pytest.approx(1 / 3)),
        0.8: (pytest.approx(1 / 3), pytest.approx(2 / 3)),
        0.3: (pytest.approx(2 / 3), pytest.approx(2 / 3)),
        0.1: (1.0, 1.0),
    }
    from orderloom.plans.churn import roc_auc

    wins = sum((a > b) + 0.5 * (a == b) for a, x in rows if x for b, y in rows if not y)
    assert roc_auc(frame).first()["roc_auc"] == pytest.approx(wins / 9)


@pytest.mark.parametrize("n", [4, 5, 6, 7, 9, 18, 33])
def test_quartiles_follow_equal_frequency_bins(spark, n):
    rng = random.Random(n)
    pdf = pd.DataFrame(
        {
            "customer_id": range(n),
            "recency": [rng.randint(0, 5) for _ in range(n)],
            "frequency": [rng.randint(1, 4) for _ in range(n)],
            "monetary": [rng.randint(1, 99) for _ in range(n)],
        }
    )
    got = rfm.rfm_quartile_score(spark.createDataFrame(pdf)).toPandas().set_index("customer_id").sort_index()
    for metric, rising in (("recency", False), ("frequency", True), ("monetary", True)):
        rank = pdf[metric].rank(method="first", ascending=rising)
        want = pd.qcut(rank, 4, labels=range(4, 0, -1)).astype(int)
        assert got[f"{metric[0]}_score"].tolist() == want.tolist(), metric


def test_quintiles_with_ties(spark):
    pdf = pd.DataFrame({"customer_id": range(30), "recency": [3] * 15 + list(range(15)), "frequency": [1] * 25 + [2] * 5, "monetary": range(30)})
    got = rfm.rfm_quintile_segments(spark.createDataFrame(pdf)).toPandas().set_index("customer_id").sort_index()
    cuts = pdf["recency"].quantile([0.2, 0.4, 0.6, 0.8]).tolist()
    want = [next((5 - i for i, c in enumerate(cuts) if v <= c), 1) for v in pdf["recency"]]
    assert got["r_score"].tolist() == want


def test_skewness_matches_the_corrected_form(skewed):
    values = skewed.select("v").toPandas()["v"]
    rows = {r["transform"]: r["skewness"] for r in transforms.skewness_report(skewed, ["v"]).collect()}
    assert rows["raw"] == pytest.approx(values.skew())
    assert rows["log"] == pytest.approx(np.log(values).skew())


def test_boxcox_finds_the_log(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"x": np.exp(rng.normal(3, 1, 3000)), "y": rng.normal(50, 3, 3000)})
    found = transforms.best_lambdas(spark.createDataFrame(pdf), ["x", "y"])
    assert abs(found["x"]) < 0.1 and abs(found["y"] - 1) < 1


def test_exact_sample_and_split(skewed):
    sample = sampling.exact_sample(skewed, "id", 0.3)
    ids = {r["id"] for r in sample.collect()}
    again = {r["id"] for r in sampling.exact_sample(skewed.repartition(7), "id", 0.3).collect()}
    assert len(ids) == 270 and ids == again
    share = skewed.where(sampling.in_train_part(F.col("id"))).count() / 900
    assert 0.75 < share < 0.85


def test_histogram_counts_every_row(skewed):
    rows = rfm.histogram(skewed, ["v"], 20).collect()
    values = skewed.select("v").toPandas()["v"]
    counts, edges = np.histogram(values, bins=20, density=False)
    got = {r["bin"]: r["count"] for r in rows}
    assert sum(got.values()) == 900
    width = edges[1] - edges[0]
    assert sum(r["density"] * width for r in rows) == pytest.approx(1.0)


def test_histogram_of_one_value(spark):
    frame = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    assert [(r["bin"], r["count"]) for r in rfm.histogram(frame, ["v"]).collect()] == [(0, 2)]


def test_checks(spark):
    frame = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "c")], "k long, c string")
    parent = spark.createDataFrame([(1,)], "id long")
    rows = quality.report(
        [
            quality.unique(frame, "t", "k"),
            quality.not_null(frame, "t", "k", "c"),
            quality.accepted_values(frame, "t", "c", ["a", "b"]),
            quality.relationship(frame, "t", "k", parent, "id"),
            quality.must_be_empty(frame.where("k > 5"), "t", "small_keys"),
        ]
    ).collect()
    found = [(r["check"], r["column"], r["failing_rows"], r["sample"]) for r in rows]
    assert found == [
        ("unique", "k", 1, "1"),
        ("not_null", "k", 1, None),
        ("not_null", "c", 1, None),
        ("accepted_values", "c", 1, "c"),
        ("relationships", "k", 1, "2"),
        ("small_keys", "", 0, None),
    ]


def test_profile(skewed):
    rows = {r["column"]: r for r in profile.profile(skewed, exact=True).collect()}
    assert rows["customer_id"]["rows"] == 900 and rows["id"]["distinct_values"] == 900
    assert rows["id"]["mean"] == pytest.approx(449.5) and rows["ts"]["mean"] is None
    top = profile.top_values(skewed, "customer_id", 1).first()
    assert (top["value"], top["count"]) == ("1", 300)
    quartiles = profile.quantiles(skewed, ["id"]).first()
    assert (quartiles["min"], quartiles["max"]) == (0.0, 899.0)


def test_samples_are_looked_up_in_failing_tables_only(spark):
    tables = {
        "fine": spark.createDataFrame([(1,), (2,), (None,)], "k long"),
        "broken": spark.createDataFrame([(1,), (10,), (10,), (9,), (9,), (None,)], "k long"),
    }
    rules = [quality.Rule("unique", name, ("k",)) for name in tables]
    rules.append(quality.Rule("relationships", "broken", ("k",), parent="fine", parent_column="k"))
    found = quality.run_checks(tables, rules)
    rows = {(r["check"], r["table"]): (r["failing_rows"], r["sample"]) for r in found.collect()}
    assert rows == {
        ("unique", "fine"): (0, None),
        ("unique", "broken"): (2, "10"),
        ("relationships", "broken"): (4, "9"),
    }
    only_unique = quality.run_checks(tables, rules[:2]).inputFiles()
    assert not any("checked-fine" in name for name in only_unique)
