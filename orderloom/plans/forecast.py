"""Forecasts with linear models, each with a later part of the data held out.

The models are fitted from sufficient statistics: one aggregate over the rows and a small
system of equations.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.functions.calendar import whole_days
from orderloom.operators.joins import join_on
from orderloom.operators.regression import (
    least_squares,
    linear_score,
    logistic,
    logistic_regression,
    predict,
)
from orderloom.operators.sampling import in_train_part
from orderloom.plans.questions import new_customers_by_month
from orderloom.plans.returns import PERIODS, Periods
from orderloom.plans.rfm import rfm_period
from orderloom.scratch import stage


def _fit_and_score(rows: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Fit on rows without ``held_out`` and predict all rows."""
    rows = stage(rows, "forecast")  # read to fit and to predict
    model = least_squares(rows.where("NOT held_out"), features, label)
    return predict(rows, model, features)


def _is(value: Column) -> Column:
    return F.when(value, 1).otherwise(0)


def daily_revenue_forecast(orders: DataFrame, held_out_days: int = 28) -> DataFrame:
    """Revenue per day from trend, weekday and month; the last days are held out."""
    daily = orders.groupBy(F.to_date("date_created").alias("day")).agg(
        F.sum("total_cents").alias("cents")
    )
    span = daily.agg(F.min("day").alias("lo"), F.max("day").alias("hi"))
    days = span.select("lo", "hi", F.explode(F.sequence("lo", "hi")).alias("day"))
    # Monday and January are the days the constant stands for
    weekdays = {f"weekday_{i}": _is(F.weekday("day") == i) for i in range(1, 7)}
    months = {f"month_{i}": _is(F.month("day") == i) for i in range(2, 13)}
    rows = (
        join_on(days, daily, "day", "left")
        .fillna(0, ["cents"])
        .select(
            "day",
            "cents",
            F.date_diff("day", "lo").alias("trend"),
            *[value.alias(name) for name, value in (weekdays | months).items()],
            (F.date_diff("hi", "day") < held_out_days).alias("held_out"),
        )
    )
    scored = _fit_and_score(rows, ["trend", *weekdays, *months], "cents")
    return scored.select(
        "day",
        (F.col("cents") / 100).alias("revenue"),
        (F.col("prediction") / 100).alias("prediction"),
        "held_out",
    )


def new_customer_forecast(orders: DataFrame, lags: int = 3, held_out_months: int = 3) -> DataFrame:
    """New customers per month from the months before.

    The window holds one row per calendar month.
    """
    months = new_customers_by_month(orders)
    span = months.agg(F.min("month").alias("lo"), F.max("month").alias("hi"))
    calendar = span.select(
        "hi", F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH"))).alias("month")
    )
    filled = join_on(calendar, months, "month", "left").fillna(0, ["new_customers"])
    order = Window.orderBy("month")
    names = [f"lag_{i}" for i in range(1, lags + 1)]
    rows = filled.select(
        "month",
        F.col("new_customers").cast("double").alias("new_customers"),
        (F.months_between("hi", "month") < held_out_months).alias("held_out"),
        *[F.lag("new_customers", i).over(order).cast("double").alias(f"lag_{i}") for i in range(1, lags + 1)],
    ).dropna()
    scored = _fit_and_score(rows, names, "new_customers")
    return scored.select("month", "new_customers", "prediction", "held_out")


def first_order_features(orders: DataFrame, days: int = 60) -> DataFrame:
    """First order of each customer and whether another followed within the days.

    Customers whose first order is too late to tell are left out.
    """
    slim = orders.select("customer_id", "order_id", "date_created", "total_cents", "cart_size")
    latest = slim.agg(F.max("date_created").alias("_latest"))
    place = F.struct("date_created", "order_id", "total_cents", "cart_size")
    firsts = slim.groupBy("customer_id").agg(F.min(place).alias("first"))
    start = F.col("first.date_created")
    # the next order is soon if any other is; the first itself counts one
    near = whole_days(start, F.col("date_created")) <= days
    firsts = (
        slim.select("customer_id", "date_created")
        .transform(join_on, firsts, "customer_id")
        .groupBy("customer_id", "first")
        .agg(F.count_if(near).alias("near"))
    )
    soon = F.col("near") > 1
    return (
        firsts.crossJoin(F.broadcast(latest))
        .where(whole_days(start, F.col("_latest")) > days)
        .select(
            "customer_id",
            (F.col("first.total_cents") / 100).alias("first_total"),
            F.coalesce(F.col("first.cart_size"), F.lit(0)).alias("first_cart_size"),
            F.hour(start).alias("first_hour"),
            F.weekday(start).alias("first_weekday"),
            F.when(soon, 1).otherwise(0).alias("retained"),
        )
    )


FIRST_ORDER = ("first_total", "first_cart_size", "first_hour", "first_weekday")


def retention_from_first_order(orders: DataFrame, days: int = 60, steps: int = 8) -> DataFrame:
    """Probability that a customer is retained, from the first order alone.

    Logistic regression by ``steps`` Newton steps, each one aggregate over the customers.
    """
    rows = first_order_features(orders, days).dropna()
    rows = stage(
        rows.withColumn("held_out", ~in_train_part(F.col("customer_id"))), "first-orders"
    )
    found = logistic_regression(rows.where("NOT held_out"), FIRST_ORDER, "retained", steps)
    score = linear_score(FIRST_ORDER, F.array(*[F.lit(c) for c in found]))
    return rows.select("customer_id", "retained", logistic(score).alias("proba"), "held_out")


def retention_error(scored: DataFrame) -> DataFrame:
    """Counts of right and wrong calls at one half, and the mean log loss, per part."""
    called, kept = F.col("proba") >= 0.5, F.col("retained") == 1
    loss = -F.log(F.when(kept, F.col("proba")).otherwise(1 - F.col("proba")))
    return scored.groupBy("held_out").agg(
        F.count_if(called & kept).alias("tp"),
        F.count_if(called & ~kept).alias("fp"),
        F.count_if(~called & kept).alias("fn"),
        F.count_if(~called & ~kept).alias("tn"),
        F.avg(loss).alias("log_loss"),
    )


def ltv_forecast(orders: DataFrame, periods: Periods = PERIODS) -> DataFrame:
    """Money in the second period from recency, frequency and money in the first."""
    (first, _, _), (second, _, _) = periods[0], periods[1]
    base = rfm_period(orders, periods)
    before = base.where(F.col("period") == first).drop("period")
    after = base.where(F.col("period") == second).select(
        "customer_id", F.col("monetary").alias("next_monetary")
    )
    rows = (
        join_on(before, after, "customer_id", "left")
        .fillna(0.0, ["next_monetary"])
        .withColumn("held_out", ~in_train_part(F.col("customer_id")))
    )
    scored = _fit_and_score(rows, ["recency", "frequency", "monetary"], "next_monetary")
    return scored.select("customer_id", "next_monetary", "prediction", "held_out")


def forecast_error(scored: DataFrame, actual: str) -> DataFrame:
    """Mean absolute error, root mean squared error and bias, fitted and held out."""
    error = F.col("prediction") - F.col(actual)
    return scored.groupBy("held_out").agg(
        F.count("*").alias("rows"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(error).alias("bias"),
    )
