"""Return probability of items per period and the plan to replace risky ones."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions.calendar import whole_days
from orderloom.functions.risk import Z_95, risk_class, wilson_bounds
from orderloom.operators.neighbours import with_next
from orderloom.scratch import stage
from orderloom.plans.cart import has_lines, item_names

# The two analysed years and the span of sales looked at.
PERIODS = (("2022_2023", "2022-03-06", "2023-03-06"), ("2023_2024", "2023-03-07", "2024-03-06"))
SPAN = ("2022-01-01", "2024-12-31")
RETURN_DAYS = 60
PRIOR = 1.0

Periods = Sequence[tuple[str, str, str]]


def between(ts: Column, low: str, high: str) -> Column:
    """Closed range; the upper end is midnight at the start of its day."""
    return ts.between(F.lit(low).cast("timestamp_ntz"), F.lit(high).cast("timestamp_ntz"))


def period_of(ts: Column, periods: Periods) -> Column:
    """Name of the period a time falls in; the periods do not overlap."""
    name = F.lit(None).cast("string")
    for label, low, high in periods:
        name = F.when(between(ts, low, high), label).otherwise(name)
    return name


def in_periods(ts: Column, periods: Periods) -> Column:
    """True inside any period: plain ranges, which the table scan can use."""
    return reduce(lambda a, b: a | b, [between(ts, low, high) for _, low, high in periods])


def sale_returns(
    orders: DataFrame, span: tuple[str, str] = SPAN, unit: str = "line", days: int = RETURN_DAYS
) -> DataFrame:
    """Sold items in the span with a flag whether the customer came back in time.

    ``line``: the next sold item of the customer decides, in the order (time, order,
    item); items of one order share its time, so only the last one can count.
    ``order``: the customer's next order decides for all items of an order.
    """
    visits = orders.where(between(F.col("date_created"), *span) & has_lines()).select(
        "order_id", "customer_id", "date_created", item_names().alias("items")
    )
    if unit not in ("line", "order"):
        raise ValueError(f"unit must be 'line' or 'order', got {unit!r}")
    ahead = with_next(visits, "customer_id", ["date_created", "order_id"], "next_date")
    following = ahead.select("*", F.explode("items").alias("item_name"))
    if unit == "line":
        last = F.col("item_name") == F.array_max("items")
        following = following.withColumn(
            "next_date", F.when(last, F.col("next_date")).otherwise(F.col("date_created"))
        )
    following = following.drop("items")
    gap = whole_days(F.col("date_created"), F.col("next_date"))
    returned = F.coalesce((gap > 0) & (gap <= days), F.lit(False))
    return following.withColumn("returned", returned)


def item_return_probability(
    orders: DataFrame,
    periods: Periods = PERIODS,
    span: tuple[str, str] = SPAN,
    unit: str = "line",
) -> DataFrame:
    """Per period and item: sales, returns, base and updated probability, bounds, class."""
    flagged = sale_returns(orders, span, unit).withColumn(
        "period", period_of(F.col("date_created"), periods)
    )
    counts = (
        flagged.where("period is not null")
        .groupBy("period", F.col("item_name").alias("item"))
        .agg(F.count("*").alias("total_sales"), F.count_if("returned").alias("return_counts"))
    )
    counts = stage(counts, "return-counts")  # read for the medians and the result
    n, k = F.col("total_sales"), F.col("return_counts")
    updated = (k + PRIOR * 0.5) / (n + PRIOR)
    rated = counts.withColumns({"base_probability": k / n, "updated_probability": updated})
    lower, upper = wilson_bounds(F.col("updated_probability"), n, Z_95)
    bounded = rated.withColumns({"ci_lower": lower, "ci_upper": upper})
    # one row per period
    medians = bounded.groupBy("period").agg(F.median("updated_probability").alias("_median"))
    risk = risk_class(F.col("ci_lower"), F.col("ci_upper"), F.col("_median"))
    return (
        bounded.join(F.broadcast(medians), "period").withColumn("churn_risk", risk).drop("_median")
    )


def high_risk_summary(rated: DataFrame) -> DataFrame:
    """High-risk items over all periods."""
    return (
        rated.where("churn_risk = 'High'")
        .groupBy("item")
        .agg(
            F.avg("updated_probability").alias("updated_probability"),
            F.sum("total_sales").alias("total_sales"),
        )
    )


def replacement_plan(rated: DataFrame) -> DataFrame:
    """Per period the items to replace and the items to offer instead.

    To replace: high-risk items with a lower bound above the third quartile of their
    group.  Candidates: low-risk items from the third quartile of probability up.
    """
    high, low = F.col("churn_risk") == "High", F.col("churn_risk") == "Low"
    cuts = rated.groupBy("period").agg(
        F.percentile(F.when(high, F.col("ci_lower")), F.lit(0.75)).alias("_high"),
        F.percentile(F.when(low, F.col("updated_probability")), F.lit(0.75)).alias("_low"),
    )
    role = F.when(high & (F.col("ci_lower") > F.col("_high")), "replace").when(
        low & (F.col("updated_probability") >= F.col("_low")), "candidate"
    )
    return (
        rated.join(F.broadcast(cuts), "period")
        .select("period", role.alias("role"), "item", "ci_lower", "updated_probability")
        .where("role is not null")
    )


def churn_weighted_uplift(rated: DataFrame, customers: DataFrame) -> DataFrame:
    """Per period the sales-weighted churn rate before and after all replacements.

    ``customers`` is one row with the number of customers the uplift is shared among.
    Sales are counts of sold lines and stand in for revenue.
    """
    high, low = F.col("churn_risk") == "High", F.col("churn_risk") == "Low"
    sums = rated.groupBy("period").agg(
        F.coalesce(F.sum(F.when(high, F.col("total_sales"))), F.lit(0)).alias("sales_high"),
        F.coalesce(F.sum(F.when(low, F.col("total_sales"))), F.lit(0)).alias("sales_low"),
        F.sum("total_sales").alias("revenue"),
        (1 - F.avg(F.when(high, F.col("updated_probability")))).alias("churn_high"),
        (1 - F.avg(F.when(low, F.col("updated_probability")))).alias("churn_low"),
    )
    share_high = F.col("sales_high") / F.col("revenue")
    share_low = F.col("sales_low") / F.col("revenue")
    after = share_low * F.col("churn_low") + share_high * F.col("churn_low")
    before = share_high * F.col("churn_high") + share_low * F.col("churn_low")
    rates = sums.crossJoin(F.broadcast(customers)).withColumns(
        {"original_churn": before, "new_churn": after}
    )
    gain = F.col("original_churn") - F.col("new_churn")
    return rates.select(
        "period",
        "revenue",
        "original_churn",
        "new_churn",
        gain.alias("improvement"),
        (F.col("revenue") * gain).alias("potential_increase"),
        (gain * 100).alias("increase_percent"),
        (F.col("revenue") / F.col("customers") * (1 - F.col("new_churn"))).alias(
            "new_ltv_per_customer"
        ),
    )
