from __future__ import annotations

import random
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from shapes import T0, orders

from orderloom.plans import churn, forecast, segmentation


@pytest.fixture(scope="module")
def customers(spark):
    """Three groups of customers that are far apart."""
    rng = random.Random(3)
    rows = []
    for i in range(150):
        recency, frequency, money = [(900, 2, 900), (30, 60, 90_000), (300, 15, 12_000)][i % 3]
        rows.append((i, recency + rng.randint(0, 9), frequency + rng.randint(0, 2), money + rng.randint(0, 99)))
    return spark.createDataFrame(rows, "customer_id long, recency long, frequency long, monetary long")


@pytest.fixture(scope="module")
def scaled(customers):
    return segmentation.scale(segmentation.transformed(customers)).cache()


def test_scaled_features_have_no_mean(scaled):
    from pyspark.ml.functions import vector_to_array

    parts = vector_to_array("scaled")
    row = scaled.agg(*[F.avg(parts[i]) for i in range(3)], *[F.stddev_samp(parts[i]) for i in range(3)]).first()
    assert list(row[:3]) == pytest.approx([0, 0, 0], abs=1e-9) and list(row[3:]) == pytest.approx([1, 1, 1])


def test_clusters_find_the_groups(scaled):
    clustered = segmentation.assign_clusters(scaled)
    by_group = clustered.groupBy((F.col("customer_id") % 3).alias("g"), "cluster").count().collect()
    assert sorted(r["count"] for r in by_group) == [50, 50, 50]
    profile = {r["cluster"]: r for r in segmentation.cluster_profile(clustered).collect()}
    assert profile[0]["mean_recency"] > profile[1]["mean_recency"] > profile[2]["mean_recency"]
    assert profile[2]["relative_monetary"] > 0 > profile[0]["relative_monetary"]
    means = segmentation.attribute_means(clustered)
    assert means.count() == 9 and means.agg(F.sum("mean_value")).first()[0] == pytest.approx(0, abs=1e-6)


def test_elbow_falls_until_the_groups_are_split(scaled):
    rows = {r["k"]: r for r in segmentation.elbow_scan(scaled, 4).collect()}
    assert rows[1]["inertia"] == pytest.approx(3 * 149, rel=1e-6)
    assert rows[1]["inertia"] > rows[2]["inertia"] > rows[3]["inertia"]
    assert rows[3]["inertia"] < 0.1 * rows[2]["inertia"]
    assert rows[3]["mean_distance"] < rows[2]["mean_distance"]


@pytest.fixture(scope="module")
def features(spark):
    """Rare buyers churn."""
    rng = random.Random(7)
    rows = []
    for i in range(600):
        period = churn.TEST if i % 5 == 0 else f"p{i % 4 + 1}"
        frequency = rng.randint(1, 20)
        rows.append((period, i, rng.randint(0, 39), frequency, frequency * 700, int(frequency < 8)))
    schema = "period string, customer_id long, recency long, frequency long, monetary long, churn int"
    return spark.createDataFrame(rows, schema)


def test_training_rows(features):
    rows = churn.training_rows(features)
    assert rows.where(F.col("period") == churn.TEST).count() == 0
    weights = {(r["churn"], r["weight"]) for r in rows.collect()}
    assert weights == {(1, 0.5), (0, 1.0)}
    share = rows.where("is_validation").count() / rows.count()
    assert 0.1 < share < 0.3


@pytest.mark.parametrize("fit", [churn.fit_boosted, churn.fit_forest])
def test_models_learn_the_rule(spark, features, fit):
    model = fit(churn.training_rows(features))
    scored = churn.score(model, churn.test_rows(features))
    assert scored.columns == [*features.columns, "proba"]
    report = churn.binary_report(churn.confusion(scored, F.col("proba") > 0.5)).first()
    assert report["accuracy"] > 0.95
    assert churn.roc_auc(scored).first()["roc_auc"] > 0.97
    weights = {r["feature"]: r["importance"] for r in churn.feature_importance(model, spark).collect()}
    assert weights["recency"] < 0.2


def test_boosting_boosts_on_overlapping_classes(spark):
    rng = random.Random(11)
    rows = []
    for i in range(2000):
        frequency, recency = rng.randint(1, 20), rng.randint(0, 39)
        gone = rng.random() < 1 / (1 + 2.718 ** (0.3 * frequency - 0.05 * recency - 1))
        rows.append(("p1", i, recency, frequency, rng.randint(100, 9000), int(gone)))
    schema = "period string, customer_id long, recency long, frequency long, monetary long, churn int"
    train = churn.training_rows(spark.createDataFrame(rows, schema)).cache()
    chosen = churn.fit_boosted(train, churn.Boosting(rounds=15, rate=0.1, depth=3))
    assert 1 < chosen.stages[-1].getNumTrees <= 15
    whole = churn.fit_boosted(train, churn.Boosting(rounds=8, rate=0.1, depth=3, patience=None))
    assert whole.stages[-1].getNumTrees == 8
    assert churn.score(whole, train).select("proba").distinct().count() > 20


def test_best_length_waits():
    assert churn.best_length([5, 4, 3, 4, 5, 2], 2) == 3
    assert churn.best_length([5, 4, 3, 4, 5, 2], 4) == 6
    assert churn.best_length([1.0], 10) == 1


def test_reports(spark):
    rows = [(1, 1)] * 3 + [(0, 1)] * 1 + [(1, 0)] * 2 + [(0, 0)] * 4
    counts = churn.confusion(spark.createDataFrame(rows, "churn int, p int"), F.col("p"))
    row = churn.binary_report(counts).first().asDict()
    assert (row["tp"], row["fp"], row["fn"], row["tn"]) == (3, 1, 2, 4)
    assert (row["accuracy"], row["precision"], row["recall"]) == (0.7, 0.75, 0.6)
    assert row["f1"] == pytest.approx(2 * 0.75 * 0.6 / 1.35)
    classes = {r["class"]: r for r in churn.class_report(counts).collect()}
    assert classes[0]["support"] == 5 and classes[0]["recall"] == 0.8


def _daily(spark, days, money):
    rows = []
    for day in range(days):
        rows.append({"created": T0 + timedelta(days=day), "total": int(money(day)), "cart": [], "customer_id": day % 50})
    return orders(spark, rows)


def test_daily_forecast_follows_trend_and_weekday(spark):
    frame = _daily(spark, 200, lambda d: 10_000 + 50 * d + 1000 * ((T0 + timedelta(days=d)).weekday() == 5))
    scored = forecast.daily_revenue_forecast(frame)
    errors = {r["held_out"]: r for r in forecast.forecast_error(scored, "revenue").collect()}
    assert errors[True]["rows"] == 28 and errors[True]["mae"] < 2.0


def test_new_customer_forecast_counts_months(spark):
    rows = [
        {"customer_id": 100 * m + i, "created": datetime(2022 + m // 12, m % 12 + 1, 3, 9), "cart": []}
        for m in range(20)
        for i in range(5 + m)
    ]
    scored = forecast.new_customer_forecast(orders(spark, rows)).toPandas().sort_values("month")
    assert len(scored) == 17 and scored["held_out"].sum() == 3
    assert scored["new_customers"].tolist() == list(np.arange(8.0, 25.0))
    assert np.abs(scored["prediction"] - scored["new_customers"]).max() < 0.5


def test_first_orders(spark):
    rows = [
        {"customer_id": 1, "created": T0, "total": 700},
        {"customer_id": 1, "created": T0 + timedelta(days=60), "total": 100},
        {"customer_id": 2, "created": T0, "total": 300},
        {"customer_id": 2, "created": T0 + timedelta(days=61)},
        {"customer_id": 3, "created": T0 + timedelta(days=50)},
        {"customer_id": 4, "created": T0 + timedelta(days=100)},
    ]
    frame = orders(spark, [{**r, "cart": []} for r in rows])
    found = forecast.first_order_features(frame, 60).toPandas().set_index("customer_id").sort_index()
    assert found.index.tolist() == [1, 2]
    assert found["retained"].tolist() == [1, 0] and found["first_total"].tolist() == [7.0, 3.0]
    assert (found["first_hour"] == 9).all() and (found["first_weekday"] == 0).all()


def test_retention_model_scores_everyone(spark):
    rng = random.Random(1)
    rows = []
    for customer in range(80):
        big = customer % 2
        rows.append({"customer_id": customer, "created": T0 + timedelta(hours=rng.randint(0, 200)), "total": 9000 if big else 500})
        if big:
            rows.append({"customer_id": customer, "created": T0 + timedelta(days=30, hours=rng.randint(0, 99)), "total": 500})
    rows.append({"customer_id": 999, "created": T0 + timedelta(days=200)})
    scored = forecast.retention_from_first_order(orders(spark, [{**r, "cart": []} for r in rows])).toPandas()
    assert len(scored) == 80
    assert scored.loc[scored["retained"] == 1, "proba"].min() > scored.loc[scored["retained"] == 0, "proba"].max()
    assert isinstance(scored, pd.DataFrame)


def test_rounds_of_the_powers_read_a_written_copy(spark, tmp_path):
    """The search for powers reads the customers four times; what they come from, not."""
    from orderloom.plans import segmentation

    seen = spark.sparkContext.accumulator(0)

    def counted(rows):
        for row in rows:
            seen.add(1)
            yield row

    data = spark.sparkContext.parallelize([(i, i, i + 1, 10 * i + 1) for i in range(50)], 2).mapPartitions(counted)
    frame = spark.createDataFrame(data, "customer_id long, recency long, frequency long, monetary long")
    found = segmentation.transformed(frame)
    assert seen.value == 50
    assert found.count() == 50


def test_boosting_takes_no_more_tasks_than_its_rows_need(spark, monkeypatch):
    rows = spark.range(100, numPartitions=40)
    cores = spark.sparkContext.defaultParallelism
    assert churn._few_tasks(rows).rdd.getNumPartitions() == cores
    monkeypatch.setattr(churn, "TASK_ROWS", 9)
    assert churn._few_tasks(rows).rdd.getNumPartitions() == 12
