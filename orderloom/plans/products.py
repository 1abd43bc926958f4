"""Item popularity, trends and the portfolio matrix."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.functions.calendar import calendar_columns, month_start, quarter_label
from orderloom.operators.joins import join_on
from orderloom.operators.ordering import exact_quantiles
from orderloom.plans.cart import each_line, has_lines, line_sales, product_sales
from orderloom.plans.star import product_avg_price
from orderloom.scratch import stage


def top_items(orders: DataFrame, n: int = 5) -> DataFrame:
    """Items that occur most often as cart elements."""
    counts = each_line(orders, [], ["item_name", "copies"]).groupBy("item_name").agg(
        F.sum(F.col("copies").cast("long")).alias("sales")
    )
    return counts.orderBy(F.desc("sales"), "item_name").limit(n)


def items_per_order(orders: DataFrame) -> DataFrame:
    return orders.agg(F.avg("cart_size").alias("avg_items_per_order"))


def price_per_item(orders: DataFrame) -> DataFrame:
    """Mean over orders of total / cart size; empty carts have no such price."""
    return orders.agg(F.avg(F.try_divide("total_cents", "cart_size")).alias("avg_price_per_item"))


def price_vs_count(orders: DataFrame) -> DataFrame:
    elements = each_line(orders, [], ["item_name", "copies", "price_cents"])
    stats = elements.groupBy(F.col("item_name").alias("item")).agg(
        F.sum(F.col("price_cents") * F.col("copies")).alias("total_price"),
        F.sum(F.col("copies").cast("long")).alias("count"),
    )
    return stats.withColumn("avg_price", F.col("total_price") / F.col("count"))


def monthly_item_sales(orders: DataFrame, price_semantics: str = "line") -> DataFrame:
    sales = line_sales(orders, price_semantics)
    return sales.groupBy("item_name", month_start(F.col("date_created")).alias("month_year")).agg(
        (F.sum("sales_cents") / 100).alias("total_sales"),
        F.sum("quantity_sold").alias("units_sold"),
    )


def monthly_pivot(
    orders: DataFrame, items: Sequence[str], price_semantics: str = "line", rest: str = "other items"
) -> DataFrame:
    """Months as rows, the named items as columns, units sold, missing as 0.

    Units of items that are not named are in the column ``rest``.
    """
    named = F.when(F.col("item_name").isin(list(items)), F.col("item_name")).otherwise(rest)
    sales = line_sales(orders, price_semantics).withColumn("_item", named)
    columns = [*items, rest]
    wide = (
        sales.groupBy(month_start(F.col("date_created")).alias("month_year"))
        .pivot("_item", columns)
        .agg(F.sum("quantity_sold"))
    )
    return wide.fillna(0, columns)


def yearly_item_sales(orders: DataFrame, price_semantics: str = "line") -> DataFrame:
    sales = line_sales(orders, price_semantics)
    return sales.groupBy(
        "item_name", F.year("date_created").alias("year"), F.month("date_created").alias("month")
    ).agg((F.sum("sales_cents") / 100).alias("total_sales"))


def quarterly_sales(orders: DataFrame, price_semantics: str = "line") -> DataFrame:
    sales = line_sales(orders, price_semantics)
    return sales.groupBy("item_name", quarter_label(F.col("date_created")).alias("quarter")).agg(
        F.sum("sales_cents").alias("sales_cents")
    )


def portfolio_matrix(orders: DataFrame, price_semantics: str = "line") -> DataFrame:
    """Share of each quarter's sales and growth into the last quarter, with a class.

    Growth is one number per item; a zero base counts as no growth.  Classes compare both
    numbers with their medians over all rows.  Tables joined with a broadcast here have
    one row, or one row per quarter.
    """
    # one row per item and quarter, read for the market, the growth and the result
    summary = stage(quarterly_sales(orders, price_semantics), "quarters")
    market = summary.groupBy("quarter").agg(F.sum("sales_cents").alias("market_cents"))
    latest = market.agg(F.max("quarter").alias("last"))
    previous = (
        market.crossJoin(F.broadcast(latest))
        .where("quarter < last")
        .agg(F.max("quarter").alias("prev"), F.max("last").alias("last"))
    )

    def in_quarter(name: str):
        hit = F.col("quarter") == F.col(name)
        return F.coalesce(F.sum(F.when(hit, F.col("sales_cents"))), F.lit(0))

    growth = (
        summary.crossJoin(F.broadcast(previous))
        .groupBy("item_name")
        .agg(in_quarter("last").alias("now"), in_quarter("prev").alias("base"))
        .select(
            "item_name",
            F.coalesce(F.try_divide(F.col("now") - F.col("base"), F.col("base")), F.lit(0.0)).alias(
                "growth_rate"
            ),
        )
    )
    share = F.col("sales_cents") / F.col("market_cents")
    rows = (
        summary.join(F.broadcast(market), "quarter")
        .transform(join_on, growth, "item_name")
        .select(
            "item_name",
            "quarter",
            (F.col("sales_cents") / 100).alias("total_sales"),
            (F.col("market_cents") / 100).alias("market_total_sales"),
            share.alias("relative_market_share"),
            "growth_rate",
        )
    )
    rows = stage(rows, "portfolio")  # read for the medians and the result
    medians = exact_quantiles(
        rows, {"relative_market_share": {"_share": 0.5}, "growth_rate": {"_growth": 0.5}}
    )
    big = F.col("relative_market_share") >= F.col("_share")
    growing = F.col("growth_rate") >= F.col("_growth")
    category = (
        F.when(big & growing, "Star")
        .when(~big & growing, "Question Mark")
        .when(big & ~growing, "Cash Cow")
        .otherwise("Dog")
    )
    return (
        rows.crossJoin(F.broadcast(medians)).withColumn("category", category).drop("_share", "_growth")
    )


def portfolio_top_n(matrix: DataFrame, n: int, quarters: Sequence[str] | None = None) -> DataFrame:
    """Best-selling items of each class and quarter."""
    kept = matrix if quarters is None else matrix.where(F.col("quarter").isin(list(quarters)))
    order = Window.partitionBy("quarter", "category").orderBy(F.desc("total_sales"), "item_name")
    return kept.withColumn("place", F.row_number().over(order)).where(F.col("place") <= n)


def orders_with_dims(orders: DataFrame, customers: DataFrame, statuses: DataFrame) -> DataFrame:
    """Orders with their customer's figures, status text and calendar columns."""
    base = orders.select(
        "order_id", "customer_id", "date_created", "status", (F.col("total_cents") / 100).alias("total")
    )
    created = F.col("date_created")
    return (
        join_on(
            base, customers.select("customer_id", "total_orders", "avg_order_value"), "customer_id", "left"
        )
        # a row per status
        .transform(join_on, F.broadcast(statuses), "status", "left")
        .withColumns({"date_key": F.to_date(created), "quarter": F.quarter(created)})
    )


def sales_with_dims(orders: DataFrame, price_semantics: str = "line") -> DataFrame:
    """Sales per order and item with the item's mean price and the calendar of the day.

    Calendar columns follow from the date, so no calendar table is joined.
    """
    sales = product_sales(orders, price_semantics)
    products = product_avg_price(orders).select("item_name", "average_price")
    return join_on(sales, products, "item_name", "left").select(
        "order_id",
        "customer_id",
        "item_name",
        "item_category",
        *calendar_columns(F.to_date("date_created")),
        "quantity_sold",
        (F.col("sales_cents") / 100).alias("total_sales"),
        "average_price",
    )


def dropped_orders(orders: DataFrame) -> DataFrame:
    """Orders that no line table shows, because their cart is empty or unreadable."""
    return orders.agg(
        F.count("*").alias("orders"),
        F.count_if(F.col("item_count").isNull()).alias("unreadable"),
        F.count_if(F.col("item_count") == 0).alias("empty"),
        F.count_if(has_lines()).alias("with_lines"),
    )
