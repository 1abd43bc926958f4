"""Revenue series, peaks and daily counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.functions.calendar import hour_text, month_start, weekday_name
from orderloom.operators.joins import join_on
from orderloom.plans.cart import line_sales
from orderloom.plans.star import opening_hours_dim

SUCCESSFUL = (2,)


def revenue_by(
    orders: DataFrame,
    parts: Mapping[str, Column],
    ts: str = "date_created",
    statuses: Sequence[int] | None = None,
    scale: int = 1,
) -> DataFrame:
    """Sum of order totals by the given parts of one timestamp.

    Orders without that timestamp are left out.  ``scale`` 1 keeps cents, 100 gives
    dollars.
    """
    kept = orders.where(F.col(ts).isNotNull())
    if statuses is not None:
        kept = kept.where(F.col("status").isin(*statuses))
    total = F.sum("total_cents")
    return kept.groupBy(*[part.alias(name) for name, part in parts.items()]).agg(
        (total if scale == 1 else total / scale).alias("total")
    )


def revenue_by_month(orders: DataFrame, ts: str = "date_paid") -> DataFrame:
    months = revenue_by(orders, {"month": month_start(F.col(ts))}, ts)
    return months.withColumn("month_str", F.date_format("month", "yy-MM"))


def revenue_by_hour(orders: DataFrame) -> DataFrame:
    hour = hour_text(F.col("date_created"))
    return revenue_by(orders, {"time": hour}, statuses=SUCCESSFUL, scale=100)


def revenue_by_hour_year(orders: DataFrame) -> DataFrame:
    parts = {"year": F.year("date_created"), "time": hour_text(F.col("date_created"))}
    return revenue_by(orders, parts, statuses=SUCCESSFUL, scale=100)


def revenue_by_hour_weekday(orders: DataFrame) -> DataFrame:
    parts = {
        "day_of_week": weekday_name(F.col("date_created")),
        "time": hour_text(F.col("date_created")),
    }
    return revenue_by(orders, parts, statuses=SUCCESSFUL, scale=100)


def revenue_by_weekday(orders: DataFrame, ts: str = "date_paid") -> DataFrame:
    return revenue_by(orders, {"weekday": weekday_name(F.col(ts))}, ts)


def best(series: DataFrame, key: str, value: str = "total") -> DataFrame:
    """The key with the greatest value; the smallest key wins a tie."""
    return series.orderBy(F.desc(value), F.asc(key)).limit(1).select(key, value)


def peak_hour(orders: DataFrame, ts: str = "date_paid") -> DataFrame:
    return best(revenue_by(orders, {"hour": F.hour(ts)}, ts), "hour")


def best_weekday(orders: DataFrame, ts: str = "date_paid") -> DataFrame:
    return best(revenue_by_weekday(orders, ts), "weekday")


def average_order_value(orders: DataFrame) -> DataFrame:
    return orders.agg(F.avg("total_cents").alias("avg_order_value"))


def revenue_per_customer(orders: DataFrame) -> DataFrame:
    totals = orders.groupBy("customer_id").agg(F.sum("total_cents").alias("total"))
    return totals.agg(F.avg("total").alias("avg_revenue_per_customer"))


def daily_order_counts(orders: DataFrame) -> DataFrame:
    """Orders per day, days without orders as 0."""
    counts = orders.groupBy(F.to_date("date_created").alias("date_created")).agg(
        F.count("*").alias("order_count")
    )
    span = counts.agg(F.min("date_created").alias("lo"), F.max("date_created").alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi")).alias("date_created"))
    return join_on(days, counts, "date_created", "left").select(
        "date_created", F.coalesce("order_count", F.lit(0)).alias("order_count")
    )


def daily_sales_with_hours(orders: DataFrame, hours: DataFrame, price_semantics: str = "line") -> DataFrame:
    """Item sales per day beside the dated opening hours."""
    daily = (
        line_sales(orders, price_semantics, [])
        .groupBy(F.to_date("date_created").alias("date_created"))
        .agg((F.sum("sales_cents") / 100).alias("total_daily_sales"))
    )
    dated = opening_hours_dim(hours)
    return daily.join(dated, F.col("date_created") == F.col("actual_date"), "left")


def revenue_anomalies(orders: DataFrame, days: int = 28, width: float = 2.0) -> DataFrame:
    """Days whose revenue is far from the mean of the days before.

    The window runs over one row per calendar day, so its size is bounded by the calendar.
    """
    daily = orders.groupBy(F.to_date("date_created").alias("day")).agg(
        F.sum("total_cents").alias("revenue_cents")
    )
    span = daily.agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    calendar = span.select(F.explode(F.sequence("lo", "hi")).alias("day"))
    filled = join_on(calendar, daily, "day", "left").fillna(0, ["revenue_cents"])
    before = Window.orderBy("day").rowsBetween(-days, -1)
    scored = filled.select(
        "day",
        "revenue_cents",
        F.avg("revenue_cents").over(before).alias("mean_before"),
        F.stddev_samp("revenue_cents").over(before).alias("std_before"),
        F.count("*").over(before).alias("days_before"),
    )
    low = F.col("revenue_cents") < F.col("mean_before") - width * F.col("std_before")
    high = F.col("revenue_cents") > F.col("mean_before") + width * F.col("std_before")
    kind = F.when(low, "drop").when(high, "spike")
    return (
        scored.where(F.col("days_before") == days)
        .withColumn("kind", kind)
        .where("kind is not null")
        .drop("days_before")
    )

