"""Customer value: spending drivers, frequency and money, contribution, lifetime value."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions.calendar import whole_days
from orderloom.operators.ordering import exact_quantiles
from orderloom.plans.cart import has_lines
from orderloom.plans.marts import paid_orders
from orderloom.scratch import stage
from orderloom.plans.returns import PERIODS, Periods, between, in_periods, period_of

# Fixed value: the span of the frequency-money study.
CORRELATION_SPAN = ("2022-04-06", "2023-03-06")


def spending_drivers(orders: DataFrame) -> DataFrame:
    """Total spending, number of orders and mean order of each paying customer."""
    return (
        paid_orders(orders)
        .groupBy("customer_id")
        .agg(
            (F.sum("price_cents") / 100).alias("total_spending"),
            F.count("order_id").alias("order_freq"),
            (F.avg("price_cents") / 100).alias("spending_per_order"),
        )
    )


def order_sales(orders: DataFrame) -> DataFrame:
    """Orders with lines: number of items sold and their money.

    A customer's frequency counts sold items (order and item pairs); both figures are
    columns of the order table, so no line is read.
    """
    return orders.where(has_lines()).select(
        "customer_id",
        "date_created",
        F.col("item_count").alias("sales"),
        F.col("line_cents").alias("sales_cents"),
    )


def _in_periods(orders: DataFrame, periods: Periods) -> DataFrame:
    ts = F.col("date_created")
    kept = order_sales(orders).where(in_periods(ts, periods))
    return kept.withColumn("period", period_of(ts, periods))


def _frequency_money(sales: DataFrame) -> DataFrame:
    return sales.groupBy("customer_id").agg(
        F.sum("sales").alias("frequency"), F.sum("sales_cents").alias("cents")
    )


def freq_money_corr(orders: DataFrame, span: tuple[str, str] = CORRELATION_SPAN) -> DataFrame:
    """One row: Pearson correlation of sale lines and money over customers."""
    sales = order_sales(orders).where(between(F.col("date_created"), *span))
    return _frequency_money(sales).agg(
        F.corr("frequency", F.col("cents") / 100).alias("correlation"),
        F.count("*").alias("customers"),
    )


def top_decile_share(orders: DataFrame, span: tuple[str, str] = CORRELATION_SPAN) -> DataFrame:
    """One row: share of sales of the most frequent tenth of customers."""
    sales = order_sales(orders).where(between(F.col("date_created"), *span))
    customers = stage(_frequency_money(sales), "frequency-money")
    cut = exact_quantiles(customers, {"frequency": {"threshold": 0.9}})
    top = F.col("frequency") >= F.col("threshold")
    return (
        customers.crossJoin(F.broadcast(cut))
        .agg(
            F.max("threshold").alias("threshold"),
            F.count_if(top).alias("top_customers"),
            (F.sum(F.when(top, F.col("cents"))) / F.sum("cents")).alias("share"),
        )
    )


def top_decile_by_period(orders: DataFrame, periods: Periods = PERIODS) -> DataFrame:
    """The most frequent tenth over both periods with money and share in each.

    Both periods are counted in one pass, missing ones as 0.
    """
    sales = _in_periods(orders, periods)

    def in_period(name: str):
        return F.coalesce(
            F.sum(F.when(F.col("period") == name, F.col("sales_cents"))), F.lit(0)
        )

    names = [name for name, _, _ in periods]
    customers = sales.groupBy("customer_id").agg(
        F.sum("sales").alias("frequency"), *[in_period(name).alias(f"c_{name}") for name in names]
    )
    customers = stage(customers, "frequency-periods")
    cut = exact_quantiles(customers, {"frequency": {"_cut": 0.9}})
    totals = customers.agg(*[F.sum(f"c_{name}").alias(f"t_{name}") for name in names])
    rows = customers.crossJoin(F.broadcast(cut)).where("frequency >= _cut")
    picked = rows.crossJoin(F.broadcast(totals))
    figures = []
    for name in names:
        cents, total = F.col(f"c_{name}"), F.col(f"t_{name}")
        figures.append((cents / 100).alias(f"total_spending_{name}"))
        figures.append((F.try_divide(cents, total) * 100).alias(f"contribution_{name}"))
    return picked.select("customer_id", "frequency", *figures)


def customer_ltv(orders: DataFrame, periods: Periods = PERIODS) -> DataFrame:
    """Lifetime value per customer and period.

    Spending per day of the customer's own lifetime, times the mean lifetime of all
    customers in the period.
    """
    lifetimes = (
        _in_periods(orders, periods)
        .groupBy("period", "customer_id")
        .agg(
            F.min("date_created").alias("_first"),
            F.max("date_created").alias("_last"),
            F.sum("sales_cents").alias("_cents"),
        )
        .select(
            "period",
            "customer_id",
            (F.col("_cents") / 100).alias("total_spending"),
            (whole_days(F.col("_first"), F.col("_last")) + 1).alias("actual_lifetime_days"),
        )
    )
    lifetimes = stage(lifetimes, "lifetimes")  # read for the means and the result
    # one row per period
    means = lifetimes.groupBy("period").agg(F.avg("actual_lifetime_days").alias("expected_lifetime"))
    per_day = F.col("total_spending") / F.col("actual_lifetime_days")
    return (
        lifetimes.join(F.broadcast(means), "period")
        .withColumn("average_daily_spending", per_day)
        .withColumn("ltv", per_day * F.col("expected_lifetime"))
    )


def average_ltv(ltv: DataFrame) -> DataFrame:
    return ltv.groupBy("period").agg(
        F.avg("ltv").alias("average_ltv"), F.count("*").alias("customers")
    )
