"""Every registered query against its SQL twin on the smallest tables."""

from __future__ import annotations

import os

import pytest
from twins import compare, connect

from __spark_entry__ import entry, oracle_sql, queries
from orderloom.workload.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


# the smallest tables hold no item whose lines make it a high risk
LARGER = {"high_risk_return_items_by_line": "/root/testdata/sf0.01"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_twin(spark, con, name):
    folder = LARGER.get(name, SF)
    assert compare(spark, con if folder == SF else connect(folder), name, folder) == []


def between(low, high, *columns):
    def check(rows):
        assert all(low <= r[c] <= high for r in rows for c in columns)

    return check


def elbow(rows):
    inertia = [r["inertia"] for r in sorted(rows, key=lambda r: r["k"])]
    assert len(rows) > 10 and inertia[0] > 2 * inertia[-1]


def roc(rows):
    points = sorted((r["fpr"], r["tpr"]) for r in rows)
    assert [p[1] for p in points] == sorted(p[1] for p in points) and points[-1] == (1.0, 1.0)


def shares(rows):
    assert abs(sum(r["importance"] for r in rows) - 1) < 1e-6


def held_out_and_not(rows):
    assert {r["held_out"] for r in rows} == {True, False}


MEASURES = ("accuracy", "precision", "recall", "f1")
UNCHECKED = {
    "elbow_scan": elbow,
    "churn_scores": between(0, 1, "proba"),
    "churn_model_report": between(0, 1, *MEASURES, "roc_auc"),
    "value_model_report": between(0, 1, *MEASURES, "roc_auc"),
    "forest_report": between(0.5, 1, "accuracy", "train_accuracy"),
    "churn_class_report": between(0, 1, "precision", "recall", "f1"),
    "forest_class_report": between(0, 1, "precision", "recall", "f1"),
    "churn_roc_points": roc,
    "churn_feature_importance": shares,
    "campaign_list": between(1, 10**12, "expected_value_lost"),
    "retention_from_first_order": between(0, 1, "proba", "retained"),
    "daily_revenue_forecast": held_out_and_not,
    "daily_revenue_forecast_error": held_out_and_not,
    "new_customer_forecast": held_out_and_not,
}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_unchecked(spark, name):
    df = queries()[name](spark, SF)
    rows = df.collect()
    assert rows
    numbers = [c for c, kind in df.dtypes if kind == "double"]
    for column in numbers:
        assert all(r[column] is None or abs(r[column]) < 1e18 for r in rows), column
    UNCHECKED.get(name, len)(rows)


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["customer_id", "churn_threshold"]
    assert df.count() > 100


def test_twins_belong_to_queries():
    assert set(oracle_sql()) <= set(queries())
