from __future__ import annotations

import math
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from orderloom.functions import calendar, keys, money, risk, scoring
from orderloom.functions.ordertime import requested_time, requested_time_full
from orderloom.functions.status import status_description


def value(spark, column, **inputs):
    names, values = list(inputs), list(inputs.values())
    frame = spark.createDataFrame([tuple(values)], names) if names else spark.range(1)
    return frame.select(column.alias("v")).first()["v"]


def wilson(k, n, z=1.96):
    p = k / n
    centre, spread = 2 * n * p + z * z, z * math.sqrt(4 * n * p * (1 - p) + z * z)
    return (centre - spread) / (2 * (n + z * z)), (centre + spread) / (2 * (n + z * z))


@pytest.mark.parametrize("n,k", [(10, 0), (10, 10), (1, 1), (1000, 500)])
def test_wilson(spark, n, k):
    low, high = risk.wilson_bounds(F.lit(k / n), F.lit(n))
    assert value(spark, F.array(low, high)) == pytest.approx(list(wilson(k, n)))


def test_wilson_without_trials(spark):
    low, high = risk.wilson_bounds(F.lit(0.5), F.lit(0))
    assert value(spark, F.array(low, high)) == [0.0, 0.0]


def test_smoothing(spark):
    assert value(spark, risk.smoothed(F.lit(2), F.lit(3), 0.005)) == pytest.approx(2.005 / 3.01)


def test_risk_class(spark):
    classes = [risk.risk_class(F.lit(a), F.lit(b), F.lit(0.5)) for a, b in [(0.6, 0.9), (0.1, 0.4), (0.4, 0.6), (0.5, 0.9)]]
    assert value(spark, F.array(*classes)) == ["Low", "High", "Moderate", "Moderate"]


def compounding(n, p):
    total, live = 0, int(n * p)
    while live >= 1:
        total, live = total + live, int(live * p)
    return total


@pytest.mark.parametrize(
    "n,p,want", [(297, 0.8291, 1369), (297, 198 / 297, 578), (297, 199 / 297, 578), (1, 0.5, 0)]
)
def test_compounding(spark, n, p, want):
    assert compounding(n, p) == want
    assert value(spark, risk.compounding_repeats(F.col("n"), F.col("p")), n=n, p=p) == want


@pytest.mark.parametrize("n,p", [(100_000, 0.999), (1, 0.999), (5, 0.2), (0, 0.5), (10, 0.0)])
def test_compounding_runs_to_the_end(spark, n, p):
    assert value(spark, risk.compounding_repeats(F.col("n"), F.col("p")), n=n, p=p) == compounding(n, p)


def test_compounding_needs_a_rate_below_one(spark):
    assert value(spark, risk.compounding_repeats(F.col("n"), F.col("p")), n=5, p=1.0) is None


@pytest.mark.parametrize(
    "day,week",
    [("2021-01-02", 0), ("2021-01-03", 1), ("2023-01-01", 1), ("2024-01-06", 0), ("2024-01-07", 1)],
)
def test_sunday_week(spark, day, week):
    assert value(spark, calendar.sunday_week(F.to_date(F.lit(day)))) == week


def test_sunday_week_all_days(spark):
    frame = spark.range(1).select(F.explode(F.expr("sequence(DATE'2019-01-01', DATE'2026-12-31')")).alias("d"))
    for day, week in frame.select("d", calendar.sunday_week(F.col("d"))).collect():
        assert week == int(day.strftime("%U")), day


def test_whole_days(spark):
    a, b = datetime(2023, 1, 1, 12), datetime(2023, 1, 3, 11)
    gap = calendar.whole_days(F.col("a").cast("timestamp_ntz"), F.col("b").cast("timestamp_ntz"))
    assert value(spark, gap, a=a, b=b) == 1


@pytest.mark.parametrize(
    "text,want,full",
    [
        (None, "09:05", "09:05"),
        ("ASAP", "09:05", "09:05"),
        ("Today 7:30PM", "19:30", "19:30"),
        ("Today 07:30pm", "19:30", "19:30"),
        ("Tomorrow 10:05", "10:05", "10:05"),
        ("Today 7:30 PM", None, "19:30"),
        ("12:15AM", "00:15", "00:15"),
        ("soon", None, None),
    ],
)
def test_requested_time(spark, text, want, full):
    frame = spark.createDataFrame([(text, datetime(2023, 5, 1, 9, 5))], "t string, c timestamp_ntz")
    row = frame.select(requested_time(F.col("t"), F.col("c")), requested_time_full(F.col("t"), F.col("c"))).first()
    assert tuple(row) == (want, full)


@pytest.mark.parametrize("total,count,want", [(5, 2, 3), (-5, 2, -3), (7, 3, 2), (10, 4, 3), (0, 4, 0), (3, 0, None)])
def test_rounded_ratio(spark, total, count, want):
    assert value(spark, money.rounded_ratio(F.col("t"), F.col("c")), t=total, c=count) == want


@pytest.mark.parametrize("cents,text", [(400, "4"), (450, "4.5"), (455, "4.55"), (5, "0.05"), (0, "0"), (1000, "10"), (-450, "-4.5")])
def test_dollars_text(spark, cents, text):
    assert value(spark, money.dollars_text(F.col("c")), c=cents) == text


def test_surrogate_key_tells_null_from_empty(spark):
    a = keys.surrogate_key(F.lit("x"), F.lit(None).cast("string"))
    b = keys.surrogate_key(F.lit("x"), F.lit(""))
    assert value(spark, a) != value(spark, b)


def test_status_texts(spark):
    early, late = F.lit(datetime(2020, 3, 1)), F.lit(datetime(2022, 3, 1))
    texts = [status_description(F.lit(10), early), status_description(F.lit(10), late), status_description(F.lit(10)), status_description(F.lit(7), late)]
    assert value(spark, F.array(*texts)) == ["Unknown (2019-2020)", "Status Unknown", "Unknown (2019-2020)", "Status Unknown"]


def test_every_score_pair_has_one_segment(spark):
    pairs = [(r, f) for r in range(1, 6) for f in range(1, 6)]
    frame = spark.createDataFrame(pairs, "r int, f int")
    names = frame.select("r", "f", scoring.segment_name(F.col("r"), F.col("f")).alias("s")).collect()
    found = {(row.r, row.f): row.s for row in names}
    assert None not in found.values()
    assert found[(5, 5)] == "Champions" and found[(3, 3)] == "Need attention" and found[(4, 5)] == "Loyal customers"


def test_tiers(spark):
    low = [scoring.tier_low_is_best(F.lit(n)) for n in (4, 6, 8, 11, 12)]
    high = [scoring.tier_high_is_best(F.lit(n)) for n in (11, 10, 8, 6, 5)]
    assert value(spark, F.array(*low)) == ["Platinum", "Gold", "Silver", "Bronze", "Green"]
    assert value(spark, F.array(*high)) == ["Platinum", "Gold", "Silver", "Bronze", "Green"]


def test_leap_day_as_of(spark):
    from orderloom.plans.star import a_year_before

    assert value(spark, a_year_before("2024-02-29").cast("date")) == date(2023, 2, 28)
