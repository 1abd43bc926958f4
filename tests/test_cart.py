from __future__ import annotations

import json

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from shapes import dicts, document, item, orders, raw

from orderloom.functions.categories import by_menu
from orderloom.plans import cart, products, star


def lines(spark, elements, **kwargs):
    return dicts(cart.cart_lines(orders(spark, [{"cart": elements}], **kwargs)), "item_id")


def test_missing_and_odd_quantity_count_as_one(spark):
    found = lines(spark, [item("a", quantity=None), item("b", quantity="x"), item("c", quantity="3")])
    assert [r["item_quantity"] for r in found] == [1, 1, 3]


def test_equal_elements_merge(spark):
    found = lines(spark, [item("a", 250, "2"), item("b", 100), item("a", 250, "2")])
    assert [(r["item_name"], r["item_id"], r["item_quantity"], r["item_price"]) for r in found] == [
        ("a", 1, 4, 5.0),
        ("b", 2, 1, 1.0),
    ]


def test_same_name_other_options_share_the_rank(spark):
    small, large = item("a", options=[("size", "S", 100)]), item("a", options=[("size", "L", 150)])
    found = lines(spark, [small, large, item("b")])
    assert [(r["item_id"], r["item_rank"]) for r in found] == [(1, 1), (2, 1), (3, 2)]
    assert found[0]["order_item_id"] == "1-1" and found[2]["order_item_ranking"] == "1-2"


def test_unreadable_and_empty_carts_have_no_lines(spark):
    rows = [
        {"items": None},
        {"items": "{broken"},
        {"cart": []},
        {"items": '{"cart_size":0}'},
        {"cart": [item("a")]},
    ]
    frame = orders(spark, rows)
    assert [r["order_id"] for r in dicts(cart.cart_lines(frame))] == [5]
    assert [r["order_id"] for r in dicts(cart.fct_order_details(frame))] == [5]
    assert cart.order_details_v1(frame).count() == 5
    assert dicts(products.dropped_orders(frame)) == [
        {"orders": 5, "unreadable": 3, "empty": 1, "with_lines": 1}
    ]


def test_elements_that_are_no_objects_keep_the_others(spark):
    elements = ["note", item("b", 200, "2", [("size", "S", 50)]), item("a", 100)]
    found = dicts(cart.cart_lines(orders(spark, [{"cart": elements}])), "item_id")
    assert [(r["item_name"], r["item_price"]) for r in found] == [(None, None), ("a", 1.0), ("b", 2.0)]
    options = dicts(cart.line_options(orders(spark, [{"cart": elements}])))
    assert [(o["item_name"], o["option_value"], o["option_price"]) for o in options] == [("b", "S", 0.5)]


def test_options_that_are_no_objects_give_empty_options(spark):
    element = item("a")
    element["options"] = ["extra hot", {"name": "size", "value": "S", "price": 50}]
    found = dicts(cart.line_options(orders(spark, [{"cart": [element]}])), "option_name")
    assert [(o["option_name"], o["option_price"]) for o in found] == [(None, None), ("size", 0.5)]


def test_first_menu_list_wins(spark):
    rule = by_menu({"Food": ["cake"], "Hot Drinks": ["tea", "cake"]})
    found = lines(spark, [item("cake"), item("soup"), item("tea")], category=rule)
    assert [r["item_category"] for r in found] == ["Food", "Kitchen", "Hot Drinks"]


def test_unit_and_line_prices(spark):
    frame = orders(spark, [{"cart": [item("a", 600, "2"), item("a", 300, "1"), item("b", 50, "3")]}])
    by_line = dicts(cart.product_sales(frame, "line"), "item_name")
    by_unit = dicts(cart.product_sales(frame, "unit"), "item_name")
    assert [(r["quantity_sold"], r["sales_cents"]) for r in by_line] == [(3, 900), (3, 50)]
    assert [r["sales_cents"] for r in by_unit] == [1500, 150]
    prices = dicts(cart.fct_product_sales(frame), "order_item_id")
    assert [r["price"] for r in prices] == [3.0, 3.0, 0.17]
    with pytest.raises(ValueError):
        cart.product_sales(frame, "piece")


def test_older_options_repeat_by_name(spark):
    option = [("size", "S", 100)]
    frame = orders(spark, [{"cart": [item("a", 1, "1", option), item("a", 2, "1", option), item("b", 3, "1", option)]}])
    assert cart.item_options_v1(frame).groupBy("item_name").count().orderBy("item_name").collect() == [
        ("a", 4),
        ("b", 1),
    ]
    counts = dicts(star.item_options_analysis(frame), "item_name")
    assert [(r["item_name"], r["count"], r["avg_option_price"]) for r in counts] == [("a", 4, 1.0), ("b", 1, 1.0)]


def test_identity_equals_ranks_over_exploded_lines(spark):
    """The array form gives what windows over exploded lines give."""
    carts = [[item(f"n{(o * i) % 3}", 100 * (i % 2 + 1), str(i % 2)) for i in range(o % 7)] for o in range(1, 60)]
    frame = raw(spark, [{"cart": c} for c in carts])
    text = F.explode(F.from_json("items", "cart array<string>")["cart"]).alias("t")
    flat = frame.select("order_id", text).select(
        "order_id",
        "t",
        F.get_json_object("t", "$.name").alias("name"),
        F.get_json_object("t", "$.quantity").cast("long").alias("q"),
        F.get_json_object("t", "$.price").cast("long").alias("p"),
    )
    by_text = Window.partitionBy("order_id").orderBy("name", "t")
    by_name = Window.partitionBy("order_id").orderBy("name")
    same = Window.partitionBy("order_id", "t")
    want = flat.select(
        "order_id",
        F.dense_rank().over(by_text).alias("item_id"),
        F.dense_rank().over(by_name).alias("item_rank"),
        "name",
        F.sum("q").over(same).alias("q"),
        (F.sum("p").over(same) / 100).alias("p"),
        "t",
    ).distinct()
    got = cart.cart_lines(cart.order_documents(frame)).select(
        "order_id", "item_id", "item_rank", "item_name", "item_quantity", "item_price", "cart_items"
    )
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_totals_survive_merging(spark):
    frame = orders(spark, [{"cart": [item("a", 250, "2"), item("a", 250, "2"), item("b", 99, "1")]}])
    row = frame.select("item_count", "line_cents").first()
    assert tuple(row) == (2, 599)


def test_fractional_cents_round_half_up(spark):
    body = json.loads(document([item("a", 100.5)], total=100))
    frame = orders(spark, [{"items": json.dumps(body)}])
    assert dicts(cart.cart_lines(frame))[0]["item_price"] == 1.01


def test_line_scan_reads_named_fields_only(spark, tmp_path):
    path = str(tmp_path / "orders")
    orders(spark, [{"cart": [item("a")]}]).write.parquet(path)
    plan = star.dim_products(spark.read.parquet(path))._jdf.queryExecution().toString()
    schema = plan[plan.rindex("ReadSchema") :]
    assert "item_name" in schema and "cart_item" not in schema and "options" not in schema


def test_odd_values_are_looked_for_once(spark):
    """Behind the test for a bracket, once per kind, and not once per use of the value."""
    plan = orders(spark, [{"cart": [item("a")]}])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(StructField(cart_total_price,") == 2


@pytest.mark.parametrize("text, number", [("", 1), ("x", 1), ("2x", 1), ("7.5", 1), (" 7 ", 7), ("+3", 3), ("-2", -2)])
def test_quantities(spark, text, number):
    assert [r["item_quantity"] for r in lines(spark, [item("a", quantity=text)])] == [number]


def test_text_without_a_digit_is_not_cast(spark):
    plan = orders(spark, [{"cart": [item("a")]}])._jdf.queryExecution().optimizedPlan().toString()
    assert "[0-9]) THEN try_cast" in plan
