from __future__ import annotations

import statistics
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from shapes import T0, dicts, item, orders

from orderloom.plans import churn, customers, marts, metrics, products, questions, retention, returns, revenue, star
from orderloom.sources.opening_hours import OPENING_HOURS, read_opening_hours


def visits(*plan):
    """Orders of customers as (customer, [day offsets])."""
    rows = []
    for customer, days in plan:
        for day in days:
            rows.append({"customer_id": customer, "created": T0 + timedelta(days=day), "cart": [item("a")], "order_id": len(rows) + 1})
    return rows


def test_thresholds_fall_back_to_all_gaps(spark):
    rows = visits((1, [0, 10, 30, 36]), (2, [0, 5]), (3, [2]))
    rows.append({"customer_id": 4, "status": 0, "paid": None, "cart": [item("a")], "order_id": 99})
    found = {r["customer_id"]: r["churn_threshold"] for r in dicts(marts.customer_churn_threshold(orders(spark, rows)))}
    own = [10, 20, 6]
    every = [*own, 5]
    overall = statistics.mean(every) + statistics.stdev(every)
    assert found == {
        1: pytest.approx(statistics.mean(own) + statistics.stdev(own)),
        2: pytest.approx(overall),
        3: pytest.approx(overall),
    }


def test_gap_of_47_hours_is_one_day(spark):
    rows = [
        {"customer_id": 1, "created": T0, "cart": [item("a")]},
        {"customer_id": 1, "created": T0 + timedelta(hours=47), "cart": [item("a")]},
    ]
    gaps = marts.order_gaps(marts.paid_orders(orders(spark, rows)))
    assert sorted(str(r["interval_days"]) for r in gaps.collect()) == ["1", "None"]


def test_repeat_label(spark):
    # gaps 10, 10, 10: threshold 10, so an equal gap is no repeat
    rows = visits((1, [0, 10, 20, 30]), (2, [0, 1, 30, 31]), (3, [0, 4, 28]))
    frame = orders(spark, rows)
    labelled = dicts(retention.order_repeat_label(frame, "2022-07-01"), "order_id")
    flags = {(r["customer_id"], (r["order_time"] - T0).days): r["next_repeat_purchase"] for r in labelled}
    assert flags[(1, 0)] is False and flags[(1, 10)] is False
    assert (1, 30) not in flags  # 1 day to the end of the data: unknown
    assert flags[(2, 0)] is True and flags[(2, 1)] is False and (2, 31) not in flags
    later = retention.order_repeat_label(frame, "2023-01-15")
    assert later.agg(F.min("order_time")).first()[0] >= datetime(2023, 1, 15)


def test_item_retention_leaves_out_items_without_repeats(spark):
    labelled = spark.createDataFrame(
        [(1, 1, True, ["a", "b"]), (1, 2, False, ["a"]), (2, 3, False, ["c"])],
        "customer_id long, order_id long, next_repeat_purchase boolean, items array<string>",
    )
    found = dicts(retention.item_retention(labelled), "item")
    assert [(r["item"], r["item_order_count"], r["item_order_count_next_repeat"]) for r in found] == [("a", 2, 1), ("b", 1, 1)]
    assert found[0]["retention_proba"] == pytest.approx(1.005 / 2.01)
    assert retention.item_retention(labelled, keep_zero=True).count() == 3


def test_loyal_customers_and_tradeoff(spark):
    rows = []
    for customer, count in ((1, 9), (2, 1), (3, 1), (4, 1)):
        rows += [(customer, 100 * customer + i, True, ["x"]) for i in range(count)]
    rows.append((5, 900, False, ["x", "y"]))
    labelled = spark.createDataFrame(rows, "customer_id long, order_id long, next_repeat_purchase boolean, items array<string>")
    items = spark.createDataFrame([("x", "High", 0.4), ("y", "Low", 0.8)], "item string, churn_risk_level string, retention_proba double")
    loyal = dicts(retention.loyal_customers(labelled, items))
    assert [(r["item"], r["customer_id"], r["order_count"]) for r in loyal] == [("x", 1, 9)]
    impact = dicts(retention.high_risk_impact(labelled, items))[0]
    assert (impact["affected_orders"], impact["unretained_orders"], impact["repeat_before"]) == (13, 1, 12)
    assert impact["retention_after"] == 0.8 and impact["iqr"] == 0.0


def test_returns_by_line_and_by_order(spark):
    rows = [
        {"customer_id": 1, "created": T0, "cart": [item("a"), item("b")]},
        {"customer_id": 1, "created": T0 + timedelta(days=5), "cart": [item("a")]},
        {"customer_id": 1, "created": T0 + timedelta(days=5, hours=3), "cart": [item("c")]},
        {"customer_id": 1, "created": T0 + timedelta(days=70), "cart": [item("a")]},
    ]
    frame = orders(spark, rows)
    period = (("all", "2022-12-01", "2023-12-01"),)
    line = {r["item"]: (r["total_sales"], r["return_counts"]) for r in dicts(returns.item_return_probability(frame, period))}
    # only "b", the last line of the first order, is followed by another order in time
    assert line == {"a": (3, 0), "b": (1, 1), "c": (1, 0)}
    order = {r["item"]: r["return_counts"] for r in dicts(returns.item_return_probability(frame, period, unit="order"))}
    assert order == {"a": 1, "b": 1, "c": 0}
    with pytest.raises(ValueError):
        returns.item_return_probability(frame, period, unit="basket")


def test_period_ends_at_the_start_of_its_last_day(spark):
    frame = spark.createDataFrame([(datetime(2023, 3, 6),), (datetime(2023, 3, 6, 0, 1),), (datetime(2023, 3, 7),)], "t timestamp_ntz")
    names = [r[0] for r in frame.select(returns.period_of(F.col("t"), returns.PERIODS)).collect()]
    assert names == ["2022_2023", None, "2023_2024"]


def test_favourites_with_ties(spark):
    rows = [
        {"customer_id": 1, "cart": [item("b"), item("a"), item("a", 200)]},
        {"customer_id": 1, "cart": [item("b"), item("a")], "created": T0 + timedelta(days=400)},
        {"customer_id": 1, "cart": [item("c")]},
        {"customer_id": 2, "cart": [item("c")]},
    ]
    found = dicts(star.dim_customers(orders(spark, rows), "2024-03-01"), "customer_id")
    assert [(r["most_frequent_item"], r["total_orders"], r["visits_last_year"]) for r in found] == [("a,b", 3, 1), ("c", 1, 0)]
    older = dicts(star.customer_v1(orders(spark, rows), "2024-03-01"), "customer_id")
    assert [(r["customer_id"], r["most_frequent_item"], r["visits_last_year"]) for r in older] == [(1, "a", 1), (2, "c", None)]


def test_price_versions(spark):
    def order(day, price):
        return {"created": T0 + timedelta(days=day), "cart": [item("a", options=[("size", "S", price)])]}

    rows = [order(0, 400), order(5, 450), order(9, 400), order(20, 500), order(20, 480)]
    found = dicts(star.item_price_history(orders(spark, rows)), "start_date", "unit_price")
    day = [(T0 + timedelta(days=d)).date() for d in (0, 5, 20)]
    assert [(r["unit_price"], r["start_date"], r["end_date"]) for r in found] == [
        (4.0, day[0], day[1]),
        (4.5, day[1], day[2]),
        (4.8, day[2], day[2]),
        (5.0, day[2], None),
    ]


@pytest.fixture()
def hours(spark, tmp_path):
    path = tmp_path / "hours.csv"
    path.write_text("date,open_time,close_time,special_note\n2023-01-02,700,1400,Short\n2023-01-03,,,Closed\nnormal_Monday,600,1600,\nbad,1,2,\n")
    frame = read_opening_hours(spark, str(path))
    assert frame.schema == OPENING_HOURS
    return frame


def test_opening_hours(spark, hours):
    staged = dicts(star.stg_opening_hours(hours), "day_category", "open_time")
    assert [r["day_category"] for r in staged] == ["Monday", "special", "special", "special"]
    rows = [{"created": datetime(2023, 1, d, 9), "cart": []} for d in (2, 3, 4, 7)]
    found = dicts(star.orders_with_hours(orders(spark, rows), hours), "order_id")
    assert [(r["opening_time"], r["closing_time"], r["special_note"]) for r in found] == [
        (700, 1400, "Short"),
        (None, None, "Closed"),
        (600, 1600, "Normal"),
        (700, 1600, "Normal"),
    ]
    assert star.opening_hours_dim(hours).count() == 3


def test_daily_counts_fill_gaps(spark):
    frame = orders(spark, visits((1, [0, 0, 3])))
    assert [r["order_count"] for r in dicts(revenue.daily_order_counts(frame), "date_created")] == [2, 0, 0, 1]


def test_growth_with_a_zero_base(spark):
    def sale(name, day, cents):
        return {"created": day, "cart": [item(name, cents)]}

    q3, q4 = datetime(2023, 8, 1), datetime(2023, 11, 1)
    rows = [sale("a", q3, 100), sale("a", q4, 150), sale("new", q4, 500), sale("gone", q3, 80)]
    found = {(r["item_name"], r["quarter"]): r for r in dicts(products.portfolio_matrix(orders(spark, rows)))}
    assert found[("a", "2023-Q4")]["growth_rate"] == 0.5
    assert found[("new", "2023-Q4")]["growth_rate"] == 0.0
    assert found[("gone", "2023-Q3")]["growth_rate"] == -1.0
    assert found[("a", "2023-Q3")]["relative_market_share"] == pytest.approx(100 / 180)


def test_pivot_fills_missing_months(spark):
    rows = [{"created": datetime(2023, m, 1), "cart": [item(n, 100, "2")]} for m, n in ((1, "a"), (2, "b"))]
    found = dicts(products.monthly_pivot(orders(spark, rows), ["a", "b", "c"]), "month_year")
    assert [(r["a"], r["b"], r["c"]) for r in found] == [(2, 0, 0), (0, 2, 0)]


def test_new_and_returning(spark):
    gaps = marts.order_gaps(marts.paid_orders(orders(spark, visits((1, [0, 4, 10]), (2, [0])))))
    found = {r["kind"]: (r["intervals"], r["avg_days_between"]) for r in dicts(questions.time_between_orders(gaps))}
    assert found == {"new": (1, 4.0), "returning": (1, 6.0), "all": (2, 5.0)}


def test_lifetime_value(spark):
    rows = visits((1, [100, 109]), (2, [100]))
    found = {r["customer_id"]: r for r in dicts(customers.customer_ltv(orders(spark, rows)))}
    assert found[1]["actual_lifetime_days"] == 10 and found[2]["actual_lifetime_days"] == 1
    assert found[1]["ltv"] == pytest.approx(2.0 / 10 * 5.5)


def test_churn_window_counts_the_boundary_twice(spark):
    day = datetime(2022, 6, 1)
    rows = [
        {"customer_id": 1, "created": day},
        {"customer_id": 1, "created": day + timedelta(days=40)},
        {"customer_id": 2, "created": day + timedelta(days=10)},
        {"customer_id": 3, "created": day + timedelta(days=100)},
    ]
    found = dicts(churn.churn_features(orders(spark, [{**r, "cart": []} for r in rows])), "period", "customer_id")
    test = {r["customer_id"]: (r["recency"], r["frequency"], r["churn"]) for r in found if r["period"] == "test"}
    assert test == {1: (0, 2, 0), 2: (30, 1, 1)}


def test_metric_needs_a_many_to_one_path(spark):
    tables = metrics.report_tables(orders(spark, visits((1, [0, 1]), (2, [0]))), "2023-06-01")
    with pytest.raises(ValueError):
        metrics.metric(tables, "orders", ["total"], ["items.item_name"])
    with pytest.raises(ValueError):
        metrics.metric(tables, "orders", ["order_id"], ["orders.status"])
    found = dicts(metrics.metric(tables, "items", ["item_quantity"], ["customers.total_orders"]), "total_orders")
    assert [(r["total_orders"], r["item_quantity"]) for r in found] == [(1, 1), (2, 2)]


def test_campaign(spark):
    frame = orders(spark, [{**r, "total": 100_000, "cart": []} for r in visits((1, [0, 100, 200]), (2, [190]), (3, [200]), (1, [300]))])
    scored = spark.createDataFrame([(1, 1, 0.5), (2, 0, 0.5)], "customer_id long, churn int, proba double")
    segments = spark.createDataFrame([(1, "Champions")], "customer_id long, segment string")
    listed = dicts(churn.campaign_list(frame, scored, segments))
    assert [(r["customer_id"], r["segment"], r["lifetime_days_total"], r["lifetime_days_last_year"]) for r in listed] == [(1, "Champions", 301, 201)]
    assert listed[0]["expected_value_lost"] == pytest.approx(300_000 * 0.5 * 365 / 201)
    table = churn.campaign_list(frame, scored, segments)
    kpis = dicts(churn.campaign_kpis(frame, table, table))[0]
    assert kpis["campaign_cost"] == 500 and kpis["revenue_saved"] == pytest.approx(kpis["actual_lost"])
