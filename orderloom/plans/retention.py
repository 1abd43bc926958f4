"""Repeat purchases, item retention risk and the effect of removing risky items.

``labelled`` is one row per paid order with its item names as an array, so the work on
items needs no join of lines and orders.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.calendar import whole_days
from orderloom.functions.risk import (
    Z_95_EXACT,
    compounding_repeats,
    risk_class,
    smoothed,
    wilson_bounds,
)
from orderloom.operators.joins import join_on
from orderloom.operators.ordering import exact_quantiles
from orderloom.plans.marts import order_gaps, paid_order_details, paid_orders, thresholds
from orderloom.scratch import stage

START = "2022-07-01"
SMOOTHING = 0.005


def _since(start: str) -> Column:
    return F.col("order_time") >= F.lit(start).cast("timestamp_ntz")


def order_repeat_label(orders: DataFrame, start: str = START) -> DataFrame:
    """Each paid order since ``start`` with whether a repeat purchase followed.

    The next order counts when its gap is below the customer's threshold.  A last order
    that is still within the threshold at the end of the data is unknown and left out.
    """
    # thresholds need all gaps before the first label: keep the sorted result
    gaps = stage(order_gaps(paid_orders(orders)), "gaps")
    latest = gaps.agg(F.max("order_time").alias("_latest"))
    limits = thresholds(gaps)
    rows = (
        gaps.where(_since(start))
        .transform(join_on, limits, "customer_id", "left")
        .crossJoin(F.broadcast(latest))
    )
    open_days = whole_days(F.col("order_time"), F.col("_latest"))
    is_last = F.col("next_order_time").isNull()
    unknown = is_last & (open_days < F.floor("churn_threshold"))
    repeat = F.coalesce(F.col("interval_days") < F.col("churn_threshold"), F.lit(False))
    return rows.where(~F.coalesce(unknown, F.lit(False))).select(
        "customer_id",
        "order_id",
        "order_time",
        "next_order_time",
        F.col("interval_days").alias("interval_to_next"),
        "churn_threshold",
        repeat.alias("next_repeat_purchase"),
        "items",
    )


def labelled_lines(orders: DataFrame, labelled: DataFrame) -> DataFrame:
    """Paid lines of the labelled orders with the label; every labelled order stays."""
    lines = paid_order_details(orders).select("order_id", "item_tracking_id", "item", "quantity")
    labels = labelled.select("customer_id", "order_id", "order_time", "next_repeat_purchase")
    return join_on(lines, labels, "order_id", "right")


def _order_items(labelled: DataFrame) -> DataFrame:
    return labelled.select(
        "customer_id", "order_id", "next_repeat_purchase", F.explode("items").alias("item")
    )


def item_retention(
    labelled: DataFrame, smoothing: float = SMOOTHING, keep_zero: bool = False
) -> DataFrame:
    """Retention probability of each item with bounds and a risk class.

    Items that no repeat purchase ever followed are left out unless ``keep_zero``.
    """
    counts = (
        _order_items(labelled)
        .groupBy("item")
        .agg(
            F.count("*").alias("item_order_count"),
            F.count_if("next_repeat_purchase").alias("item_order_count_next_repeat"),
        )
    )
    counts = stage(counts, "item-counts")  # read for the median and the result
    if not keep_zero:
        counts = counts.where("item_order_count_next_repeat > 0")
    n, k = F.col("item_order_count"), F.col("item_order_count_next_repeat")
    lower, upper = wilson_bounds(k / n, n, Z_95_EXACT)
    rated = counts.select(
        "item",
        "item_order_count",
        "item_order_count_next_repeat",
        smoothed(k, n, smoothing).alias("retention_proba"),
        lower.alias("ci_lower"),
        upper.alias("ci_upper"),
    )
    middle = exact_quantiles(rated, {"retention_proba": {"_median": 0.5}})
    level = risk_class(F.col("ci_lower"), F.col("ci_upper"), F.col("_median"))
    return (
        rated.crossJoin(F.broadcast(middle)).withColumn("churn_risk_level", level).drop("_median")
    )


def _high_risk(items: DataFrame) -> DataFrame:
    return items.where("churn_risk_level = 'High'").select("item")


def affected_items(labelled: DataFrame, items: DataFrame) -> DataFrame:
    """Order-item rows of high-risk items."""
    return join_on(_order_items(labelled), _high_risk(items), "item", "left_semi")


def high_risk_impact(labelled: DataFrame, items: DataFrame) -> DataFrame:
    """One row: orders with high-risk items, their retention, that of the other items."""
    touched = (
        affected_items(labelled, items)
        .select("customer_id", "order_id", "next_repeat_purchase")
        .distinct()
        .agg(
            F.count("*").alias("affected_orders"),
            F.count_if(~F.col("next_repeat_purchase")).alias("unretained_orders"),
        )
    )
    rest = exact_quantiles(
        items.where("churn_risk_level <> 'High'"),
        {"retention_proba": {"q25": 0.25, "retention_after": 0.5, "q75": 0.75}},
    )
    kept = F.col("affected_orders") - F.col("unretained_orders")
    return touched.crossJoin(F.broadcast(rest)).select(
        "affected_orders",
        "unretained_orders",
        kept.alias("repeat_before"),
        F.try_divide(kept, F.col("affected_orders")).alias("retention_before"),
        "retention_after",
        (F.col("q75") - F.col("q25")).alias("iqr"),
    )


def cohort_compounding(cohorts: DataFrame) -> DataFrame:
    """Cumulative repeat purchases of cohorts (cohort, initial_orders, retention_proba)."""
    total = compounding_repeats(F.col("initial_orders"), F.col("retention_proba"))
    return cohorts.withColumn("total_new_repeat_purchases", total)


def impact_cohorts(impact: DataFrame) -> DataFrame:
    """The affected orders before and after the removal as two cohorts."""
    after = F.struct(F.lit("after").alias("cohort"), F.col("retention_after").alias("retention_proba"))
    before = F.struct(
        F.lit("before").alias("cohort"), F.col("retention_before").alias("retention_proba")
    )
    return impact.select(
        F.col("affected_orders").alias("initial_orders"), F.inline(F.array(after, before))
    )


def removal_revenue(
    orders: DataFrame, labelled: DataFrame, items: DataFrame, impact: DataFrame, start: str = START
) -> DataFrame:
    """One row: extra repeat purchases and their revenue if high-risk items went."""
    n = F.col("affected_orders")
    gain = compounding_repeats(n, F.col("retention_after")) - compounding_repeats(
        n, F.col("retention_before")
    )
    paid = paid_orders(orders)
    customers = affected_items(labelled, items).select("customer_id").distinct()
    spending = (
        join_on(paid, customers, "customer_id", "left_semi")
        .groupBy("customer_id")
        .agg(F.avg("price_cents").alias("mean_cents"))
        .agg((F.avg("mean_cents") / 100).alias("avg_spending_per_order"))
    )
    sales = paid.where(_since(start)).agg((F.sum("price_cents") / 100).alias("period_sales"))
    row = (
        impact.select(gain.alias("repeat_increase"))
        .crossJoin(F.broadcast(spending))
        .crossJoin(F.broadcast(sales))
    )
    extra = F.col("repeat_increase") * F.col("avg_spending_per_order")
    return row.withColumn("extra_revenue", extra).withColumn(
        "revenue_increase", F.try_divide(extra, F.col("period_sales"))
    )


def item_customer_orders(labelled: DataFrame, items: DataFrame) -> DataFrame:
    """Orders of each customer for each high-risk item, beside the item's loyalty limit."""
    counts = (
        affected_items(labelled, items)
        .groupBy("item", "customer_id")
        .agg(
            F.count("*").alias("order_count"),
            F.count_if(~F.col("next_repeat_purchase")).alias("_unretained"),
        )
    )
    limits = counts.groupBy("item").agg(
        F.min("order_count").alias("min_order_count"),
        F.max("order_count").alias("max_order_count"),
        (F.avg("order_count") + F.stddev_samp("order_count")).alias("loyalty_threshold"),
    )
    return join_on(counts, limits, "item")


def loyal_customers(labelled: DataFrame, items: DataFrame) -> DataFrame:
    """Loyal customers of high-risk items who never failed to return after one.

    "Never failed" is an anti join on (item, customer); the same counts already tell.
    """
    loyal = F.col("order_count") > F.col("loyalty_threshold")
    return (
        item_customer_orders(labelled, items)
        .where(loyal & (F.col("_unretained") == 0))
        .select("item", "customer_id", "order_count", "loyalty_threshold")
    )


def loyalty_tradeoff(
    orders: DataFrame, labelled: DataFrame, items: DataFrame, impact: DataFrame, start: str = START
) -> DataFrame:
    """One row: customers gained and lost if high-risk items went."""
    unretained = (
        affected_items(labelled, items)
        .where(~F.col("next_repeat_purchase"))
        .agg(F.count_distinct("customer_id").alias("unretained_customers"))
    )
    lost = loyal_customers(labelled, items).agg(F.count("*").alias("customers_lost"))
    total = (
        paid_orders(orders)
        .where(_since(start))
        .agg(F.count_distinct("customer_id").alias("total_customers"))
    )
    row = (
        impact.select("retention_after")
        .crossJoin(F.broadcast(unretained))
        .crossJoin(F.broadcast(lost))
        .crossJoin(F.broadcast(total))
    )
    gained = F.floor(F.col("unretained_customers") * F.col("retention_after"))
    net = F.col("customers_retained") - F.col("customers_lost")
    return (
        row.withColumn("customers_retained", F.coalesce(gained, F.lit(0)))
        .withColumn("net_retention_gain", net)
        .select(
            "customers_retained",
            "customers_lost",
            "net_retention_gain",
            "total_customers",
            F.try_divide("net_retention_gain", "total_customers").alias("net_share"),
        )
    )
