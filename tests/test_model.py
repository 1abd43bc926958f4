"""The table graph, key contracts, fused checks and metric links."""

from __future__ import annotations

import os
import time
from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from shapes import T0, dicts, item, orders, raw

from orderloom.operators import quality
from orderloom.operators.joins import KeyMismatch, check_keys, join_on
from orderloom.plans import metrics, pipeline
from orderloom.plans import model as model_tables
from orderloom.plans.model import Model, Source, Table
from orderloom.sources.opening_hours import holiday_hours


def test_order_of_tables():
    tables = [Table("c", ("a", "b"), None), Table("a", ("s",), None), Table("b", ("a",), None)]
    assert [t.name for t in Model(tables, "x").order(["s"])] == ["a", "b", "c"]
    with pytest.raises(ValueError, match="called s"):
        Model(tables, "x").order([])
    with pytest.raises(ValueError, match="wait for each other"):
        Model([Table("a", ("b",), None), Table("b", ("a",), None)], "x").order([])
    with pytest.raises(ValueError, match="same name"):
        Model([Table("a", (), None), Table("a", (), None)], "x")


def test_each_table_is_built_once(spark, tmp_path):
    built = []

    def make(name):
        def build(*parents):
            built.append(name)
            return parents[0].withColumn(name, F.lit(1))

        return build

    tables = [Table(n, p, make(n)) for n, p in {"a": ("s",), "b": ("a",), "c": ("a",), "d": ("b", "c")}.items()]
    model = Model(tables, str(tmp_path))
    model.write(spark, {"s": Source(spark.range(3))})
    assert built == ["a", "b", "c", "d"]
    assert set(model.read(spark, "d").columns) == {"id", "a", "b", "d"}


def _month_rows(months, price=100):
    return [
        {"order_id": 10 * m + k, "customer_id": m, "created": T0 + timedelta(days=31 * m), "cart": [item("tea", price)]}
        for m in months
        for k in range(3)
    ]


def _files(root, table):
    found = {}
    for folder, _, names in os.walk(f"{root}/{table}"):
        for name in names:
            if name.endswith(".parquet"):
                path = os.path.join(folder, name)
                found[path] = os.stat(path).st_mtime_ns
    return found


def test_a_changed_month_rewrites_that_month_only(spark, tmp_path):
    root = str(tmp_path / "model")
    first = raw(spark, _month_rows(range(4)))
    model = pipeline.shop_model(root, "2024-01-01")
    hours = holiday_hours(orders(spark, _month_rows(range(4))))
    model.write(spark, pipeline.shop_sources(first, hours))
    before = {t: _files(root, t) for t in ("orders", "cart_lines", "fct_order_details", "line_options")}

    changed = raw(spark, _month_rows([0, 2, 3]) + _month_rows([1], price=700))
    model.write(spark, pipeline.shop_sources(changed, hours), ["2023-02"])
    for table, old in before.items():
        new = _files(root, table)
        same = {p for p in old if new.get(p) == old[p]}
        assert {p for p in old if "order_month=2023-02" not in p} == same, table
        assert all("order_month=2023-02" in p for p in new.keys() - same)
    lines = model.read(spark, "cart_lines")
    assert sorted(r["item_price"] for r in lines.collect()) == [1.0] * 9 + [7.0] * 3
    # tables of all months follow as well
    paid = model.read(spark, "paid_order_details").agg(F.sum("item_price").alias("all")).first()
    assert paid["all"] == pytest.approx(9 * 1.0 + 3 * 7.0)


def test_a_month_that_loses_all_rows(spark, tmp_path):
    model = pipeline.shop_model(str(tmp_path), "2024-01-01")
    model = Model([t for t in model.tables if t.name in ("orders", "cart_lines")], model.root)
    hours = spark.createDataFrame([], "date string, open_time int, close_time int, special_note string")
    model.write(spark, pipeline.shop_sources(raw(spark, _month_rows(range(3))), hours))
    model.write(spark, pipeline.shop_sources(raw(spark, _month_rows([0, 2])), hours), ["2023-02"])
    assert model.read(spark, "orders").count() == model.read(spark, "cart_lines").count() == 6
    with pytest.raises(ValueError):
        model.write(spark, {}, ["2023-2' OR 1"])


def test_keys_of_other_types_are_refused(spark):
    longs = spark.createDataFrame([(1, "x")], "customer_id long, item_name string")
    texts = spark.createDataFrame([("1", "x")], "customer_id string, item_name string")
    with pytest.raises(KeyMismatch, match="bigint on the left, string on the right"):
        join_on(longs, texts, "customer_id")
    with pytest.raises(KeyMismatch, match="its contract is bigint"):
        join_on(texts, texts.alias("b"), "customer_id")
    with pytest.raises(KeyMismatch, match="missing on the right"):
        join_on(longs, texts.drop("item_name"), ["item_name"])
    floats = spark.createDataFrame([(1.0,)], "amount double")
    with pytest.raises(KeyMismatch, match="compare exactly"):
        check_keys(floats, floats, ["amount"])
    assert join_on(longs, texts.drop("customer_id"), "item_name").count() == 1


def test_fused_checks_equal_single_ones(spark):
    child = spark.createDataFrame(
        [(1, "a", 5), (1, None, 6), (2, "c", None), (None, "a", 7), (3, "a", 40)], "id long, kind string, parent long"
    )
    parent = spark.createDataFrame([(5,), (6,), (None,)], "key long")
    rule = quality.Rule
    rules = [
        rule("unique", "child", ("id",)),
        rule("unique", "child", ("id", "kind")),
        rule("unique", "parent", ("key",)),
        rule("not_null", "child", ("kind",), key="id"),
        rule("accepted_values", "child", ("kind",), values=("a", "b")),
        rule("relationships", "child", ("parent",), parent="parent", parent_column="key"),
        rule("early", "child", failing="parent > 6"),
    ]
    got = sorted(map(tuple, quality.run_checks({"child": child, "parent": parent}, rules).collect()))
    q = quality
    single = q.report(
        [
            q.unique(child, "child", "id"), q.unique(child, "child", "id", "kind"), q.unique(parent, "parent", "key"),
            q.not_null(child, "child", "kind", key="id"), q.accepted_values(child, "child", "kind", ["a", "b"]),
            q.relationship(child, "child", "parent", parent, "key"), q.must_be_empty(child.where("parent > 6"), "child", "early"),
        ]
    )
    assert got == sorted(map(tuple, single.collect()))
    assert ("relationships", "child", "parent", 2, "7") in got  # 7 before 40, as numbers


def test_fused_checks_of_empty_tables(spark):
    empty = spark.createDataFrame([], "id long, kind string")
    rules = [quality.Rule("unique", "t", ("id",)), quality.Rule("not_null", "t", ("kind",))]
    assert [r["failing_rows"] for r in quality.run_checks({"t": empty}, rules).collect()] == [0, 0]


@pytest.fixture
def tables(spark):
    return {
        "customers": spark.createDataFrame([(1, 2), (2, 1), (9, 4)], "customer_id long, total_orders long"),
        "orders": spark.createDataFrame(
            [(10, 1, 2, 100), (11, 1, 2, 50), (12, 2, 1, 7), (13, None, 1, 3)],
            "order_id long, customer_id long, status int, total long",
        ),
        "items": spark.createDataFrame(
            [(10, "tea", "Hot", 1), (10, "cake", "Food", 2), (11, "tea", "Hot", 3), (12, "tea", "Cold", 4)],
            "order_id long, item_name string, item_category string, item_quantity long",
        ),
        "option_counts": spark.createDataFrame(
            [("tea", "size", 5), ("tea", "milk", 6), ("pie", "size", 7)], "item_name string, option_name string, count long"
        ),
    }


def test_many_to_many_counts_nothing_twice(tables):
    found = dicts(metrics.metric(tables, "option_counts", ["count"], ["items.item_category"]), "item_category")
    # tea is in three item rows of two categories: its options count once in each
    assert found == [
        {"item_category": "Cold", "count": 11}, {"item_category": "Hot", "count": 11}, {"item_category": None, "count": 7},
    ]
    found = dicts(metrics.metric(tables, "customers", ["total_orders"], ["orders.status"]), "status")
    assert found == [
        {"status": 1, "total_orders": 1}, {"status": 2, "total_orders": 2}, {"status": None, "total_orders": 4},
    ]


def test_links_in_a_row_and_own_columns(tables):
    found = metrics.metric(tables, "option_counts", ["count"], ["option_counts.option_name", "orders.status"])
    assert {(r["option_name"], r["status"]): r["count"] for r in found.collect()} == {
        ("size", 2): 5, ("size", 1): 5, ("milk", 2): 6, ("milk", 1): 6, ("size", None): 7,
    }


def test_one_way_links(tables):
    found = metrics.metric(tables, "items", ["item_quantity"], ["orders.status"])
    assert {r["status"]: r["item_quantity"] for r in found.collect()} == {2: 6, 1: 4}
    with pytest.raises(ValueError, match="no link"):
        metrics.metric(tables, "orders", ["total"], ["items.item_category"])


def test_part_of_a_model_has_what_it_is_made_from():
    tables = [Table("a", ("s",), None), Table("b", ("a",), None), Table("c", ("a",), None), Table("d", ("b",), None)]
    assert [t.name for t in Model(tables, "x").part("d").tables] == ["a", "b", "d"]
    assert [t.name for t in Model(tables, "x").part("a", "c").tables] == ["a", "c"]


def test_rows_come_to_their_month_once(spark, tmp_path, monkeypatch):
    """Documents are dealt by month before they are parsed, and their lines not again."""
    dealt = []
    to_months = model_tables._to_months
    monkeypatch.setattr(model_tables, "_to_months", lambda f, c: dealt.append(f.columns) or to_months(f, c))
    source = raw(spark, _month_rows(range(4)))
    model = pipeline.shop_model(str(tmp_path)).part("cart_lines", "line_options", "fct_order_details")
    model.write(spark, {"raw_orders": Source(source, "date_created")})
    assert dealt == [source.columns]
    folders = sorted(d for d in os.listdir(tmp_path / "cart_lines") if "=" in d)
    assert len(folders) == 4 and folders == sorted(d for d in os.listdir(tmp_path / "orders") if "=" in d)
    assert model.read(spark, "orders").count() == source.count()


def test_a_query_of_orders_writes_no_other_table(spark, tmp_path):
    from orderloom.workload import q_star

    class Small:
        raw_once = raw(spark, _month_rows(range(4)))
        hours = holiday_hours(raw_once)

    shop = Small()
    shop.spark = spark
    assert os.listdir(q_star._model(shop, "orders").root) == ["orders"]


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {name for name in names if name.startswith("shuffle_")}


def test_written_tables_leave_no_shuffle_files(spark, tmp_path):
    before = _shuffle_files(spark)
    model = pipeline.shop_model(str(tmp_path), "2024-01-01")
    hours = holiday_hours(orders(spark, _month_rows(range(4))))
    model.write(spark, pipeline.shop_sources(raw(spark, _month_rows(range(4))), hours))
    until = time.time() + 20  # files are removed in the background
    while _shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not _shuffle_files(spark) - before
    assert model.read(spark, "paid_lines_with_threshold").count() == 12


def test_lines_come_to_their_folders_unsorted(spark, tmp_path):
    """A sort by month of whole lines spills; a file per month is open instead."""
    model = pipeline.shop_model(str(tmp_path)).part("cart_lines", "line_options", "fct_order_details")
    model.write(spark, {"raw_orders": Source(raw(spark, _month_rows(range(4))), "date_created")})
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    runs = spark._jsparkSession.sharedState().statusStore().executionsList()
    plans = [runs.apply(i).physicalPlanDescription() or "" for i in range(runs.size())]
    for name in ("orders", "cart_lines", "line_options", "fct_order_details"):
        found = [plan for plan in plans if f"{tmp_path}/{name}," in plan]
        assert found, name
        assert not any("Sort" in plan for plan in found), name


def test_settings_of_a_write_end_with_it(spark, tmp_path):
    before = {key: spark.conf.get(key, None) for key in model_tables.WRITING}
    seen = []

    def build(rows):
        seen.append({key: spark.conf.get(key) for key in model_tables.WRITING})
        raise ValueError("no such table")

    with pytest.raises(ValueError, match="no such table"):
        Model([Table("a", ("s",), build)], str(tmp_path)).write(spark, {"s": Source(spark.range(3))})
    assert seen == [model_tables.WRITING]
    assert {key: spark.conf.get(key, None) for key in model_tables.WRITING} == before
