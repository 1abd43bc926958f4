"""All tables of the model, and writing them."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.operators.joins import join_on
from orderloom.plans import cart, marts, star
from orderloom.plans.cart import CategoryRule, no_menu
from orderloom.plans.model import Model, Source, Table


def shop_model(root: str, as_of: star.AsOf = None, category: CategoryRule = no_menu) -> Model:
    """The tables from the sources ``raw_orders`` and ``hours``, written under ``root``."""
    orders = ("orders",)

    def documents(raw: DataFrame) -> DataFrame:
        return cart.order_documents(raw, category)

    def paid_with_limits(paid: DataFrame, limits: DataFrame) -> DataFrame:
        return join_on(paid, limits, "customer_id", "left")

    return Model(
        [
            Table("orders", ("raw_orders",), documents, "date_created", row_by_row=True),
            Table("cart_lines", orders, cart.cart_lines, "date_created", row_by_row=True),
            Table("line_options", orders, cart.line_options, "date_created", row_by_row=True),
            Table("fct_order_details", orders, cart.fct_order_details, "date_created", row_by_row=True),
            Table("fct_product_sales", orders, cart.fct_product_sales),
            Table("fct_order_item_options", orders, cart.fct_order_item_options),
            Table("dim_customers", orders, lambda o: star.dim_customers(o, as_of)),
            Table("dim_products", orders, star.dim_products),
            Table("dim_payment_status", orders, star.dim_payment_status),
            Table("dim_item_options", orders, star.dim_item_options),
            Table("dim_time", orders, star.dim_time),
            Table("opening_hours", ("hours",), star.opening_hours_dim),
            Table("orders_with_hours", ("orders", "hours"), star.orders_with_hours),
            Table("paid_order_details", orders, marts.paid_order_details),
            Table("customer_churn_threshold", orders, marts.customer_churn_threshold),
            Table(
                "paid_lines_with_threshold",
                ("paid_order_details", "customer_churn_threshold"),
                paid_with_limits,
            ),
            Table("item_price_history", orders, star.item_price_history),
        ],
        root,
    )


def shop_sources(raw: DataFrame, hours: DataFrame) -> dict[str, Source]:
    return {"raw_orders": Source(raw, "date_created"), "hours": Source(hours)}


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    counts = [
        frame.agg(F.lit(name).alias("table"), F.count("*").alias("rows"))
        for name, frame in tables.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), counts)
