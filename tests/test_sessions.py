from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from orderloom.operators.sessions import sessions
from orderloom.streaming import kpi

START = datetime(2024, 1, 1)
FIELDS = "event_id long, user_id long, ts timestamp_ntz, event_type string, value double, props string"


def events(seed: int, n: int):
    """One user has a third of the rows, some times are null, some equal, some 30 min apart."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        user = 0 if rng.random() < 0.34 else rng.choice([None, *range(1, 40)])
        at = None if rng.random() < 0.02 else START + timedelta(minutes=5 * rng.randrange(8 * n))
        rows.append((i, user, at, "view", rng.choice([None, 1.0, 2.5]), None))
    return rows


def plain(frame):
    window = F.session_window("ts", "30 minutes").alias("s")
    return frame.groupBy("user_id", window).agg(F.count("*").alias("events"), F.sum("value").alias("value")).select(
        "user_id", "s.start", "s.end", "events", "value"
    )


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("ranges", [1, 3, 50])
def test_equal_to_session_window(spark, ranges):
    frame = spark.createDataFrame(events(ranges, 1500), FIELDS).repartition(4)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    try:
        assert rows_of(kpi.visit_sessions(frame)) == rows_of(plain(frame))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_a_session_over_many_ranges(spark):
    """One user without any gap fills all ranges and still has one session."""
    rows = [(i, 7, START + timedelta(minutes=i), "view", 1.0, None) for i in range(3000)]
    frame = spark.createDataFrame(rows, FIELDS)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 20)
    try:
        (row,) = kpi.visit_sessions(frame).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert (row["events"], row["value"]) == (3000, 3000.0)
    assert row["session_end"] - row["session_start"] == timedelta(minutes=2999 + 30)


def test_one_instant_spreads_over_ranges(spark):
    rows = [(i, 7, START, "view", 1.0, None) for i in range(2000)]
    (row,) = kpi.visit_sessions(spark.createDataFrame(rows, FIELDS)).collect()
    assert row["events"] == 2000


def test_empty_and_untimed(spark):
    assert kpi.visit_sessions(spark.createDataFrame([], FIELDS)).collect() == []
    rows = [(1, 1, None, "view", 1.0, None)]
    assert kpi.visit_sessions(spark.createDataFrame(rows, FIELDS)).collect() == []


def test_other_keys_and_sums(spark):
    rows = [("a", START, 2), ("a", START + timedelta(hours=1), 3), ("a", START + timedelta(hours=3), 4)]
    frame = spark.createDataFrame(rows, "who string, at timestamp_ntz, n int")
    found = sessions(frame, "who", "at", "1 hour", {"total": F.col("n")})
    assert sorted(r["total"] for r in found.collect()) == [4, 5]
