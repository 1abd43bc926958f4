"""Raw orders made from star tables, and what of them is written."""

from __future__ import annotations

import glob
import json
import re
from datetime import datetime

import pytest
from shapes import dicts

from orderloom.scratch import _folder
from orderloom.sources import retail_tables
from orderloom.workload.shop import Shop

DAY = datetime(2000, 5, 1)
ORDERS = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz"
LINES = (
    "l_orderkey long, l_partkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string"
)
PARTS = "p_partkey long, p_name string, p_size int, p_retailprice double"


@pytest.fixture
def star(spark, tmp_path):
    tables = {
        "orders": ([(k, 1, "F", 10.0, DAY) for k in (10, 11, 503, 504)], ORDERS),
        "lineitem": (
            [(k, 1, n, 2.0, 1.5, "N") for k in (10, 503, 504) for n in (1, 6, 7)]
            + [(11, 2, 1, 2.0, 1.5, None), (None, 1, 1, 2.0, 1.5, "N")],
            LINES,
        ),
        "part": ([(1, "old rod", 3, 9.0), (2, None, 3, 9.0)], PARTS),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_documents(spark, star):
    found = {r["order_id"]: r["items"] for r in dicts(retail_tables.raw_orders(spark, star))}
    cart = json.loads(found[10])["cart"]
    assert [line.get("quantity") for line in cart] == [None, "2", "2", "x"]
    assert json.loads(found[11])["cart"] == []
    assert found[504] is None
    with pytest.raises(ValueError):
        json.loads(found[503])


def test_documents_are_made_in_compiled_code(spark, star):
    """The virtual machine does not compile methods of 8,000 bytes and more."""
    frame = retail_tables.raw_orders(spark, star)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = frame._jdf.queryExecution().executedPlan()
        text = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenString(plan)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", text))) < 8000


def test_line_texts_are_not_shuffled(spark, star):
    plan = retail_tables.raw_orders(spark, star)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Generate explode") < plan.index("REPARTITION_BY_COL")


def test_raw_orders_are_written_for_their_readers_only(spark, star):
    shop = Shop(spark, star)
    before = len(glob.glob(f"{_folder(spark)}/raw-orders-*"))
    assert shop.orders.count() == 4 and shop.hours.count() == 1
    assert len(glob.glob(f"{_folder(spark)}/raw-orders-*")) == before
    assert shop.raw.count() == 4
    assert len(glob.glob(f"{_folder(spark)}/raw-orders-*")) == before + 1


def test_heads_of_orders_leave_the_carts_unparsed(spark, star):
    shop = Shop(spark, star)
    heads = dicts(shop.order_heads, "date_created")
    assert "orders" not in shop.__dict__
    assert heads == dicts(shop.orders.select(*shop.order_heads.columns), "date_created")
    again = Shop(spark, star)
    written = again.orders
    assert again.order_heads is written
