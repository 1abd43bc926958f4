from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from shapes import T0, item, orders, raw

from orderloom import scratch
from orderloom.sources import raw_orders, sinks
from orderloom.plans import cart
from orderloom.streaming import kpi


def test_raw_round_trip(spark, tmp_path):
    path = str(tmp_path / "raw")
    sinks.write_parquet(raw(spark, [{"cart": [item("a")]}]), path)
    assert raw_orders.read_raw_orders(spark, path).count() == 1


def test_tables_by_name(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "a.parquet"))
    assert raw_orders.read_tables(spark, str(tmp_path), ["a"])["a"].count() == 3


def test_months_are_pruned(spark, tmp_path):
    path = str(tmp_path / "orders")
    rows = [{"created": T0 + timedelta(days=31 * i), "cart": [item("a")]} for i in range(4)]
    sinks.write_orders_by_month(orders(spark, rows), path)
    one = spark.read.parquet(path).where(F.col("order_month") == "2023-02")
    assert one.count() == 1
    assert "PartitionFilters: [isnotnull(order_month" in one._jdf.queryExecution().toString()


def test_csv_and_view(spark, tmp_path):
    path = str(tmp_path / "csv")
    sinks.write_csv(spark.range(2).toDF("a"), path)
    assert spark.read.option("header", True).csv(path).columns == ["a"]
    sinks.as_view(spark.range(2), "two_rows")
    assert spark.sql("SELECT count(*) FROM two_rows").first()[0] == 2


def test_table_is_not_replaced_unasked(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS shop_test LOCATION '{tmp_path}/db'")
    sinks.write_table(spark.range(1), "shop_test.t")
    with pytest.raises(AnalysisException):
        sinks.write_table(spark.range(1), "shop_test.t")
    sinks.append_table(spark.range(2), "shop_test.t")
    assert spark.table("shop_test.t").count() == 3
    sinks.write_table(spark.range(5), "shop_test.t", "overwrite")
    assert spark.table("shop_test.t").count() == 5
    spark.sql("DROP DATABASE shop_test CASCADE")


class FakeSession:
    """Just enough of a session to choose a folder."""

    def __init__(self, master, folder):
        self.conf = self
        self.folder = folder
        self.sparkContext = self
        self.master = master
        self.applicationId = f"app-{master}"

    def get(self, key, default):
        assert key == "spark.checkpoint.dir"
        return self.folder or default


def test_shared_folder_is_the_named_one():
    assert scratch.shared_root(FakeSession("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    assert scratch.shared_root(FakeSession("local[2]", "/named")) == "/named"
    own = scratch.shared_root(FakeSession("local[2]", None))
    assert own and own == scratch.shared_root(FakeSession("local[2]", None))


def test_staged_table_is_a_written_copy(spark):
    staged = scratch.stage(spark.range(4), "ids")
    assert staged.count() == 4
    assert scratch.shared_root(spark) in staged.inputFiles()[0]


def test_staging_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.shared_root(FakeSession("spark://host:7077", None))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.shared_root(FakeSession("local-cluster[2,1,1024]", None))


def _events(spark, path, rows):
    frame = spark.createDataFrame(rows, kpi.EVENTS)
    frame.coalesce(1).write.mode("append").parquet(path)


def _event(i, minutes, kind="purchase", value=2.0, user=1):
    return (i, datetime(2024, 1, 1) + timedelta(minutes=minutes), user, kind, value, "{}")


def test_stream_equals_table(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    _events(spark, source, [_event(1, 5), _event(2, 50), _event(3, 70), _event(4, 75, "view")])
    _events(spark, source, [_event(5, 400)])
    query = kpi.write_windows(kpi.revenue_kpi(kpi.read_events(spark, source)), out, str(tmp_path / "c"))
    query.awaitTermination(120)
    got = {(r["window_start"], r["revenue"], r["events"]) for r in spark.read.parquet(out).collect()}
    table = kpi.revenue_kpi(spark.read.schema(kpi.EVENTS).parquet(source))
    want = {(r["window_start"], r["revenue"], r["events"]) for r in table.collect()}
    # the last window stays open until the watermark passes it
    assert got == {w for w in want if w[0] < datetime(2024, 1, 1, 5)} and len(got) == 2


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "c"))
    _events(spark, source, [_event(1, 600)])
    stream = kpi.revenue_kpi(kpi.read_events(spark, source))
    kpi.write_windows(stream, out, state).awaitTermination(120)
    _events(spark, source, [_event(2, 5), _event(3, 900)])
    query = kpi.write_windows(kpi.revenue_kpi(kpi.read_events(spark, source)), out, state)
    query.awaitTermination(120)
    starts = [r["window_start"].hour for r in spark.read.parquet(out).collect()]
    assert starts == [10]


def test_late_raw_rows_are_counted(spark, tmp_path):
    """Several late rows of one window are several, a late row of an open window is none."""
    source, counts, state = (str(tmp_path / n) for n in ("in", "counts", "c"))
    _events(spark, source, [_event(1, 600), _event(2, 590)])

    def run():
        kpi.write_late_counts(kpi.read_events(spark, source), counts, state).awaitTermination(120)
        return kpi.late_rows(spark, counts)

    assert run() == 0
    late = [_event(3, 5), _event(4, 6), _event(5, 7), _event(6, 8, "view"), _event(7, 541)]
    _events(spark, source, [*late, _event(8, 900)])
    assert run() == 3
    _events(spark, source, [_event(9, 601), _event(10, 850)])
    assert run() == 4 == kpi.late_rows(spark, counts)


def test_sessions(spark):
    frame = spark.createDataFrame([_event(1, 0), _event(2, 29), _event(3, 60), _event(4, 10, user=2)], kpi.EVENTS)
    found = sorted((r["user_id"], r["events"]) for r in kpi.visit_sessions(frame).collect())
    assert found == [(1, 1), (1, 2), (2, 1)]


def _days(spark, money, first=0):
    start = datetime(2024, 1, 1)
    rows = [(start + timedelta(days=first + i), float(m)) for i, m in enumerate(money) if m is not None]
    return spark.createDataFrame(rows, "window_start timestamp_ntz, revenue double")


def test_daily_alerts(spark):
    frame = _days(spark, [100 + i % 2 for i in range(30)] + [900])
    assert [r["window_start"].day for r in kpi.daily_alerts(frame).collect()] == [31]


def test_no_alert_before_28_days(spark):
    early = _days(spark, [100, 101, 5000] + [100 + i % 2 for i in range(25)])
    assert kpi.daily_alerts(early).collect() == []
    gap = _days(spark, [100 + i % 2 for i in range(29)] + [None, 100])  # a day without sales
    assert [r["revenue"] for r in kpi.daily_alerts(gap).collect()] == [0.0]


def test_streamed_alerts_know_the_days_before(spark, tmp_path):
    source, alerts, state = (str(tmp_path / n) for n in ("in", "alerts", "c"))
    money = [100 + i % 3 for i in range(60)]
    money[35] = 900
    money[50] = None  # closed without a row, as is the day after
    money[51] = None
    for first in range(0, 60, 10):
        _days(spark, money[first : first + 10], first).coalesce(1).write.mode("append").parquet(source)
        days = spark.readStream.schema("window_start timestamp_ntz, revenue double").parquet(source)
        kpi.write_daily_alerts(days, alerts, state).awaitTermination(120)
    columns = ("window_start", "revenue", "mean_before", "std_before")
    got = sorted(tuple(r[c] for c in columns) for r in spark.read.parquet(alerts).collect())
    want = sorted(tuple(r[c] for c in columns) for r in kpi.daily_alerts(_days(spark, money)).collect())
    assert [g[0] for g in got] == [w[0] for w in want] and datetime(2024, 2, 5) in [g[0] for g in got]
    for g, w in zip(got, want):
        assert g[1:] == pytest.approx(w[1:])


def test_alert_series_are_apart(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    calm = _days(spark, [100 + i % 2 for i in range(40)]).withColumn("shop", F.lit("calm"))
    wild = _days(spark, [100 + i % 2 for i in range(39)] + [900]).withColumn("shop", F.lit("wild"))
    calm.unionAll(wild).coalesce(1).write.parquet(source)
    schema = "window_start timestamp_ntz, revenue double, shop string"
    stream = kpi.daily_alert_stream(spark.readStream.schema(schema).parquet(source), F.col("shop"))
    kpi.write_windows(stream, out, str(tmp_path / "c")).awaitTermination(120)
    assert [r["series"] for r in spark.read.parquet(out).collect()] == ["wild"]


def test_menu_file(spark, tmp_path):
    from orderloom.functions.categories import with_menu
    from orderloom.sources.menu import read_menu

    path = tmp_path / "menu.csv"
    rows = "".join(f"{i},filler {i},Filler\n" for i in range(3, 12_000))
    path.write_text("position,item_name,item_category\n2,cake,Hot Drinks\n1,cake,Food\n3,tea,Hot Drinks\n" + rows)
    menu = read_menu(spark, str(path))
    lines = cart.each_line(
        orders(spark, [{"cart": [item("cake"), item("tea"), item("pie")]}]), ["order_id"], ["item_name", "item_category"]
    )
    found = with_menu(lines, menu)
    assert found.columns == lines.columns
    assert {r["item_name"]: r["item_category"] for r in found.collect()} == {
        "cake": "Food", "tea": "Hot Drinks", "pie": "Kitchen",
    }
