"""Small hand-made inputs."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from orderloom.plans import cart
from orderloom.sources.raw_orders import RAW_ORDERS

T0 = datetime(2023, 1, 2, 9, 0)


def item(name, price=100, quantity="1", options=()):
    """A cart element; quantity None leaves the field out."""
    element = {"name": name, "price": price}
    if quantity is not None:
        element["quantity"] = quantity
    element["options"] = [{"name": n, "value": v, "price": p} for n, v, p in options]
    return element


def document(elements, total=None, **extra):
    total = sum(e.get("price", 0) for e in elements if isinstance(e, dict)) if total is None else total
    body = {
        "cart_size": len(elements),
        "cart_surcharge": 0,
        "cart_total_price": total,
        "cart_gst": total // 11,
        "order_time": "ASAP",
        "cart": list(elements),
    }
    body.update(extra)
    return json.dumps(body, separators=(",", ":"))


def raw(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Raw orders; unnamed fields get plain values."""
    data = []
    for i, row in enumerate(rows, start=1):
        created = row.get("created", T0)
        items = row.get("items", document(row.get("cart", [])))
        data.append(
            (
                row.get("order_id", i),
                row.get("customer_id", 1),
                "x",
                created,
                row.get("paid", created + timedelta(minutes=5)),
                row.get("total", 1000),
                row.get("status", 2),
                items,
            )
        )
    return spark.createDataFrame(data, RAW_ORDERS)


def orders(spark: SparkSession, rows: list[dict], **kwargs) -> DataFrame:
    return cart.order_documents(raw(spark, rows), **kwargs)


def dicts(df: DataFrame, *order: str) -> list[dict]:
    rows = [row.asDict(recursive=True) for row in df.collect()]
    return sorted(rows, key=lambda r: tuple(str(r[c]) for c in order)) if order else rows
