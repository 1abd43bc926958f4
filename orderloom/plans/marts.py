"""Paid orders and the churn threshold of each customer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.calendar import whole_days
from orderloom.functions.money import dollars
from orderloom.operators.joins import join_on
from orderloom.operators.neighbours import with_next
from orderloom.plans.cart import each_line, has_lines, item_names

PAID_STATUSES = (1, 2)


def is_paid() -> Column:
    return F.col("date_paid").isNotNull() & F.col("status").isin(*PAID_STATUSES)


def paid_order_details(orders: DataFrame) -> DataFrame:
    """Paid cart lines."""
    lines = each_line(
        orders.where(is_paid()),
        ["order_id", "customer_id", "cart_total_cents", "date_created"],
        ["item_id", "item_name", "item_category", "copies", "quantity", "price_cents"],
    )
    return lines.select(
        "order_id",
        "customer_id",
        dollars("cart_total_cents").alias("order_price"),
        F.col("item_id").alias("item_tracking_id"),
        F.col("item_name").alias("item"),
        F.col("item_category").alias("category"),
        (F.col("quantity") * F.col("copies")).alias("quantity"),
        dollars(F.col("price_cents") * F.col("copies")).alias("item_price"),
        F.col("date_created").alias("order_time"),
    )


def paid_orders(orders: DataFrame) -> DataFrame:
    """Paid orders with the distinct names of their items in one row."""
    items = item_names()
    return orders.where(is_paid() & has_lines()).select(
        "order_id",
        "customer_id",
        F.col("date_created").alias("order_time"),
        F.col("cart_total_cents").alias("price_cents"),
        items.alias("items"),
    )


def order_gaps(paid: DataFrame) -> DataFrame:
    """Each order with the time of the customer's next one and the days between."""
    following = with_next(paid, "customer_id", ["order_time", "order_id"], "next_order_time")
    days = whole_days(F.col("order_time"), F.col("next_order_time"))
    return following.withColumn("interval_days", days)


def _mean_plus_std(n: Column, total: Column, squares: Column) -> Column:
    """Mean plus sample deviation from sums of whole days; null below two gaps."""
    mean = total / n
    spread = F.greatest((squares - total * total / n) / (n - 1), F.lit(0.0))
    return F.when(n > 1, mean + F.sqrt(spread))


def thresholds(gaps: DataFrame) -> DataFrame:
    """Mean plus one standard deviation of a customer's gaps, or of all gaps when the
    customer has fewer than two.

    Sums of whole days are exact and can be added up again, so the figure over all gaps
    comes from the customer rows and the gaps are computed once.
    """
    days = F.col("interval_days").cast("double")
    sums = gaps.groupBy("customer_id").agg(
        F.count(days).cast("double").alias("n"),
        F.coalesce(F.sum(days), F.lit(0.0)).alias("s"),
        F.coalesce(F.sum(days * days), F.lit(0.0)).alias("q"),
    )
    overall = sums.agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"))
    fallback = overall.select(
        _mean_plus_std(F.col("n"), F.col("s"), F.col("q")).alias("fallback")
    )
    own = _mean_plus_std(F.col("n"), F.col("s"), F.col("q"))
    return sums.crossJoin(F.broadcast(fallback)).select(
        "customer_id", F.coalesce(own, "fallback").alias("churn_threshold")
    )


def customer_churn_threshold(orders: DataFrame) -> DataFrame:
    gaps = order_gaps(paid_orders(orders).drop("items", "price_cents"))
    return thresholds(gaps)


def paid_lines_with_threshold(orders: DataFrame) -> DataFrame:
    """Paid cart lines with the churn threshold of their customer."""
    return join_on(
        paid_order_details(orders), customer_churn_threshold(orders), "customer_id", "left"
    )


def churn_threshold_v1(orders: DataFrame) -> DataFrame:
    """Older form: every paid order whose status is not 10."""
    kept = orders.where(F.col("date_paid").isNotNull() & (F.col("status") != 10) & has_lines())
    paid = kept.select("order_id", "customer_id", F.col("date_created").alias("order_time"))
    return thresholds(order_gaps(paid))
