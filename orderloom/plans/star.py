"""Dimensions and order facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.functions.calendar import calendar_columns, iso_weekday, weekday_name
from orderloom.functions.keys import surrogate_key
from orderloom.functions.money import dollars, dollars_text, rounded_ratio
from orderloom.functions.status import status_description
from orderloom.operators.joins import join_on
from orderloom.plans.cart import each_line, has_lines, item_names, option_rows, weighted_options_v1

AsOf = str | Column | None


def a_year_before(as_of: AsOf) -> Column:
    """Midnight one calendar year before ``as_of`` (default: today)."""
    day = F.current_date() if as_of is None else F.to_date(F.lit(as_of))
    return F.add_months(day, -12).cast("timestamp_ntz")


def _favourites(orders: DataFrame) -> DataFrame:
    """Items each customer bought in most orders, ties included.

    The counts are combined before the shuffle, so a busy customer brings one row per
    item and task to its window.
    """
    named = orders.select(
        "customer_id",
        F.explode(item_names()).alias("item_name"),
    )
    counts = named.groupBy("customer_id", "item_name").agg(F.count("*").alias("n"))
    place = F.dense_rank().over(Window.partitionBy("customer_id").orderBy(F.desc("n")))
    return counts.withColumn("place", place).where("place = 1").drop("place", "n")


def dim_customers(orders: DataFrame, as_of: AsOf = None) -> DataFrame:
    served = orders.where(has_lines())
    recent = F.col("date_created") >= a_year_before(as_of)
    base = served.groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"),
        dollars(rounded_ratio(F.sum("total_cents"), F.count("total_cents"))).alias("avg_order_value"),
        F.max("date_created").alias("last_order_date"),
        F.count_if(recent).alias("visits_last_year"),
    )
    favourites = (
        _favourites(served)
        .groupBy("customer_id")
        .agg(F.expr("listagg(item_name, ',') WITHIN GROUP (ORDER BY item_name)").alias("most_frequent_item"))
    )
    return join_on(base, favourites, "customer_id", "left")


def customer_v1(orders: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Older form: all orders, dates by payment, visits null when none, one row per
    favourite item, items counted per cart element."""
    recent = F.col("date_paid") >= a_year_before(as_of)
    base = orders.groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"),
        dollars(rounded_ratio(F.sum("total_cents"), F.count("total_cents"))).alias("avg_order_value"),
        F.max("date_paid").alias("last_order_date"),
        F.nullif(F.count_if(recent), F.lit(0)).alias("visits_last_year"),
    )
    elements = each_line(orders, ["customer_id"], ["item_name", "copies"])
    counts = elements.groupBy("customer_id", "item_name").agg(F.sum("copies").alias("n"))
    place = F.rank().over(Window.partitionBy("customer_id").orderBy(F.desc("n")))
    favourites = counts.withColumn("place", place).where("place = 1").select(
        "customer_id", F.col("item_name").alias("most_frequent_item")
    )
    return join_on(base, favourites, "customer_id", "left")


def customer_dim_v1(orders: DataFrame) -> DataFrame:
    """Older customer dimension: items counted once per order."""
    base = orders.groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"),
        dollars(rounded_ratio(F.sum("total_cents"), F.count("total_cents"))).alias("avg_order_value"),
        F.max("date_created").alias("last_order_date"),
    )
    favourites = _favourites(orders).withColumnRenamed("item_name", "most_frequent_item")
    return join_on(base, favourites, "customer_id", "left")


def dim_products(orders: DataFrame) -> DataFrame:
    return each_line(orders, [], ["item_name", "item_category"]).distinct()


def product_avg_price(orders: DataFrame) -> DataFrame:
    """Older product dimension: mean price per cart element."""
    elements = each_line(orders, [], ["item_name", "item_category", "copies", "price_cents"])
    priced = F.when(F.col("price_cents").isNotNull(), F.col("copies"))
    total = F.sum(F.col("price_cents") * F.col("copies"))
    return elements.groupBy("item_name", "item_category").agg(
        (total / F.sum(priced) / 100).alias("average_price")
    )


def dim_payment_status(orders: DataFrame) -> DataFrame:
    return orders.where(has_lines()).select("status", "status_description").distinct()


def payment_status_v1(orders: DataFrame) -> DataFrame:
    statuses = orders.select("status").distinct()
    return statuses.withColumn("status_description", status_description(F.col("status")))


def _option_versions(orders: DataFrame) -> DataFrame:
    """First day of each option price and the day the next price starts."""
    seen = option_rows(orders).groupBy(
        "item_name", "option_name", "option_value", "option_price_cents"
    ).agg(F.to_date(F.min("date_created")).alias("start_date"))
    history = Window.partitionBy("item_name", "option_name", "option_value").orderBy(
        "start_date", "option_price_cents"
    )
    return seen.withColumn("end_date", F.lead("start_date").over(history))


def dim_item_options(orders: DataFrame) -> DataFrame:
    key = surrogate_key(
        F.col("item_name"),
        F.col("option_name"),
        F.col("option_value"),
        dollars_text(F.col("option_price_cents")),
    )
    return _option_versions(orders).select(
        key.alias("item_option_id"),
        "item_name",
        "option_name",
        "option_value",
        dollars("option_price_cents").alias("option_price"),
        "start_date",
        "end_date",
    )


def item_price_history(orders: DataFrame) -> DataFrame:
    """Price versions of the size option."""
    key = surrogate_key(
        F.col("item_name"), F.col("option_value"), dollars_text(F.col("option_price_cents"))
    )
    return (
        _option_versions(orders)
        .where(F.col("option_name") == "size")
        .select(
            key.alias("item_price_id"),
            "item_name",
            F.col("option_value").alias("size_or_flavour"),
            dollars("option_price_cents").alias("unit_price"),
            "start_date",
            "end_date",
        )
    )


def dim_time(orders: DataFrame) -> DataFrame:
    """Every day from the first to the last order."""
    span = orders.agg(
        F.to_date(F.min("date_created")).alias("lo"), F.to_date(F.max("date_created")).alias("hi")
    )
    days = span.select(F.explode(F.sequence("lo", "hi")).alias("d"))
    return days.select(*calendar_columns(F.col("d")))


def dim_time_between(spark, first: str = "2020-01-01", last: str = "2030-12-31") -> DataFrame:
    """The calendar between two fixed days."""
    ends = [F.to_date(F.lit(first)), F.to_date(F.lit(last))]
    days = spark.range(1).select(F.explode(F.sequence(*ends)).alias("d"))
    return days.select(*calendar_columns(F.col("d")))


def stg_opening_hours(hours: DataFrame) -> DataFrame:
    usual = F.col("date").like("normal_%")
    return hours.select(
        F.when(~usual, F.col("date").try_cast("date")).alias("actual_date"),
        "open_time",
        "close_time",
        "special_note",
        F.when(usual, F.replace("date", F.lit("normal_"), F.lit("")))
        .otherwise("special")
        .alias("day_category"),
    )


def opening_hours_dim(hours: DataFrame) -> DataFrame:
    """One row per date; the usual weekdays share the row without a date."""
    return (
        stg_opening_hours(hours)
        .groupBy("actual_date")
        .agg(
            F.min("open_time").alias("open_time"),
            F.max("close_time").alias("close_time"),
            F.max("special_note").alias("special_note"),
        )
    )


def orders_with_hours(orders: DataFrame, hours: DataFrame) -> DataFrame:
    """Every order with the opening hours of its day.

    Dated hours win; a noted day without times is closed; else 6:00 on weekdays, 7:00 on
    weekends, until 16:00.  There is one row per calendar day of exceptions, and the
    optimizer picks the join by the measured size of that table.
    """
    dated = stg_opening_hours(hours).where("actual_date is not null").drop("day_category")
    day = F.to_date("date_created")
    joined = orders.join(dated, day == F.col("actual_date"), "left")
    usual_open = F.when(iso_weekday(day).between(1, 5), 600).otherwise(700)

    def time(column: str, usual: Column) -> Column:
        closed = F.col("special_note").isNotNull() & F.col(column).isNull()
        return F.when(~closed, F.coalesce(F.col(column), usual))

    return joined.select(
        "order_id",
        "customer_id",
        "ip_addr",
        "date_created",
        "date_paid",
        dollars("total_cents").alias("total"),
        "status",
        "cart_size",
        dollars("surcharge_cents").alias("cart_surcharge"),
        dollars("cart_total_cents").alias("cart_total_price"),
        dollars("gst_cents").alias("cart_gst"),
        time("open_time", usual_open).alias("opening_time"),
        time("close_time", F.lit(1600)).alias("closing_time"),
        F.coalesce("special_note", F.lit("Normal")).alias("special_note"),
        weekday_name(day).alias("day_of_week"),
        "status_description",
    )


def total_sales_by_item(orders: DataFrame) -> DataFrame:
    """Sum of written prices per item; ``total_orders`` counts cart elements."""
    elements = each_line(orders, [], ["item_name", "copies", "price_cents"])
    return elements.groupBy("item_name").agg(
        dollars(F.sum(F.col("price_cents") * F.col("copies"))).alias("total_sales"),
        F.sum(F.col("copies").cast("long")).alias("total_orders"),
    )


def item_options_analysis(orders: DataFrame) -> DataFrame:
    """How often each option value was taken and its mean price, from weights."""
    weight = F.col("weight").cast("long")
    priced = F.when(F.col("option_price_cents").isNotNull(), weight)
    total = F.sum(F.col("option_price_cents") * weight)
    return (
        weighted_options_v1(orders)
        .groupBy("item_name", "option_name", "option_value")
        .agg(
            F.sum(weight).alias("count"),
            dollars(rounded_ratio(total, F.sum(priced))).alias("avg_option_price"),
        )
    )
