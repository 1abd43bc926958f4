"""Business questions on new items, new customers and opening hours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.functions.calendar import iso_weekday, month_start
from orderloom.operators.joins import join_on
from orderloom.plans.cart import product_sales
from orderloom.plans.products import monthly_item_sales
from orderloom.plans.star import opening_hours_dim


def new_item_prices(orders: DataFrame, days: int = 90) -> DataFrame:
    """Mean unit price of items in their first days of sale and after."""
    sales = product_sales(orders)
    first = sales.groupBy("item_name").agg(F.min("date_created").alias("first_sold"))
    fresh = F.col("date_created") < F.col("first_sold") + F.make_dt_interval(F.lit(days))
    return (
        join_on(sales, first, "item_name")
        .groupBy(fresh.alias("is_new"))
        .agg(
            F.try_divide(F.sum("sales_cents"), F.sum("quantity_sold") * 100).alias("avg_unit_price"),
            F.count("*").alias("sales"),
        )
    )


def new_customers_by_month(orders: DataFrame) -> DataFrame:
    firsts = orders.groupBy("customer_id").agg(F.min("date_created").alias("first"))
    return firsts.groupBy(month_start(F.col("first")).alias("month")).agg(
        F.count("*").alias("new_customers")
    )


def cohort_retention(orders: DataFrame) -> DataFrame:
    """Customers of each first month who order again k months later.

    The window of a customer holds one row per month with orders.
    """
    active = orders.select("customer_id", month_start(F.col("date_created")).alias("month")).distinct()
    firsts = active.withColumn("cohort", F.min("month").over(Window.partitionBy("customer_id")))
    offset = F.months_between("month", "cohort").cast("int")
    counts = firsts.groupBy("cohort", offset.alias("month_offset")).agg(
        F.count("*").alias("customers")
    )
    size = F.max(F.when(F.col("month_offset") == 0, F.col("customers"))).over(
        Window.partitionBy("cohort")
    )
    return counts.withColumn("retention_rate", F.col("customers") / size)


def _first_and_rest(paid: DataFrame, value: str) -> DataFrame:
    """One row per kind of order: number and sum of a value over first and later orders.

    The first order of a customer is found while its values are summed, so the orders
    are read and grouped once.
    """
    place = F.struct("order_time", "order_id")
    customers = paid.groupBy("customer_id").agg(
        F.min_by(value, place).alias("first"),
        F.sum(value).alias("total"),
        F.count(value).alias("n"),
    )
    has_first = F.col("first").isNotNull().cast("long")
    sums = customers.agg(
        F.sum("first").alias("new_total"),
        F.sum(has_first).alias("new_n"),
        F.sum("total").alias("all_total"),
        F.sum("n").alias("all_n"),
    )
    kinds = {
        "new": (F.col("new_total"), F.col("new_n")),
        "returning": (F.col("all_total") - F.col("new_total"), F.col("all_n") - F.col("new_n")),
        "all": (F.col("all_total"), F.col("all_n")),
    }
    rows = [
        F.struct(F.lit(kind).alias("kind"), total.alias("total"), n.alias("n"))
        for kind, (total, n) in kinds.items()
    ]
    return sums.select(F.inline(F.array(*rows))).where("n > 0")


def time_between_orders(gaps: DataFrame) -> DataFrame:
    """Mean days to the next order: overall, after a first order, after later orders."""
    return _first_and_rest(gaps, "interval_days").select(
        "kind", F.col("n").alias("intervals"), (F.col("total") / F.col("n")).alias("avg_days_between")
    )


def orders_per_customer(orders: DataFrame) -> DataFrame:
    counts = orders.groupBy("customer_id").agg(F.count("*").alias("n"))
    return counts.agg(F.avg("n").alias("avg_orders_per_customer"), F.count("*").alias("customers"))


def aov_new_vs_returning(paid: DataFrame) -> DataFrame:
    kinds = _first_and_rest(paid, "price_cents").where("kind <> 'all'")
    return kinds.select(
        "kind",
        (F.col("total") / F.col("n") / 100).alias("avg_order_value"),
        F.col("n").alias("orders"),
    )


def _open_hours(day: Column) -> tuple[Column, Column]:
    closed = F.col("special_note").isNotNull() & F.col("open_time").isNull()
    usual = F.when(iso_weekday(day).between(1, 5), 600).otherwise(700)
    opens = F.when(~closed, F.coalesce("open_time", usual))
    shuts = F.when(~closed, F.coalesce("close_time", F.lit(1600)))
    return opens, shuts


def revenue_per_open_hour(orders: DataFrame, hours: DataFrame) -> DataFrame:
    """Revenue of each clock hour per day the shop was open in it."""
    dated = opening_hours_dim(hours).where("actual_date is not null")
    daily = orders.groupBy(
        F.to_date("date_created").alias("day"), F.hour("date_created").alias("hour")
    ).agg(F.sum("total_cents").alias("cents"))
    span = daily.agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    days = span.select(F.explode(F.sequence("lo", "hi")).alias("day"))
    opens, shuts = _open_hours(F.col("day"))
    first = F.floor(opens / 100).cast("int")
    last = (F.ceil(shuts / 100) - 1).cast("int")
    slots = days.join(dated, F.col("day") == F.col("actual_date"), "left").select(
        "day", F.explode(F.sequence(first, last)).alias("hour")
    )
    filled = join_on(slots, daily, ["day", "hour"], "left")
    result = filled.groupBy("hour").agg(
        (F.coalesce(F.sum("cents"), F.lit(0)) / 100).alias("revenue"), F.count("*").alias("open_days")
    )
    return result.withColumn("revenue_per_open_hour", F.col("revenue") / F.col("open_days"))


def price_elasticity(orders: DataFrame) -> DataFrame:
    """Slope of log units over log unit price across the months of each item."""
    months = monthly_item_sales(orders).where("units_sold > 0 and total_sales > 0")
    price = F.ln(F.col("total_sales") / F.col("units_sold"))
    units = F.ln(F.col("units_sold"))
    return (
        months.select("item_name", price.alias("x"), units.alias("y"))
        .groupBy("item_name")
        .agg(F.regr_slope("y", "x").alias("elasticity"), F.count("*").alias("months"))
    )
