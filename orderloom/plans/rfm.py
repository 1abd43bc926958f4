"""Recency, frequency, money: base tables, scores, segments, shares, distributions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.functions import scoring
from orderloom.functions.calendar import whole_days
from orderloom.operators.ordering import exact_quantiles, rank_cutoffs
from orderloom.plans.customers import order_sales
from orderloom.plans.returns import PERIODS, Periods, between, in_periods
from orderloom.scratch import stage

METRICS = ("recency", "frequency", "monetary")


def rfm_orders(orders: DataFrame) -> DataFrame:
    """Days since the last order (from the latest order of all), orders, cents."""
    latest = orders.agg(F.max("date_created").alias("_latest"))
    base = orders.groupBy("customer_id").agg(
        F.max("date_created").alias("_last"),
        F.count("date_created").alias("frequency"),
        F.sum("total_cents").alias("monetary"),
    )
    recency = whole_days(F.col("_last"), F.col("_latest"))
    return base.crossJoin(F.broadcast(latest)).select(
        "customer_id", recency.alias("recency"), "frequency", "monetary"
    )


def rfm_period(orders: DataFrame, periods: Periods = PERIODS) -> DataFrame:
    """The same from sale lines, per period, up to the day after the period."""
    sales = order_sales(orders).where(in_periods(F.col("date_created"), periods))
    found = [
        F.when(
            between(F.col("date_created"), low, high),
            F.struct(
                F.lit(name).alias("period"),
                F.expr(f"TIMESTAMP_NTZ '{high}' + INTERVAL 1 DAY").alias("end"),
            ),
        )
        for name, low, high in periods
    ]
    tagged = sales.select("*", F.inline(F.filter(F.array(*found), lambda p: p.isNotNull())))
    return (
        tagged.groupBy("period", "end", "customer_id")
        .agg(
            F.max("date_created").alias("_last"),
            F.sum("sales").alias("frequency"),
            (F.sum("sales_cents") / 100).alias("monetary"),
        )
        .select(
            "period",
            "customer_id",
            whole_days(F.col("_last"), F.col("end")).alias("recency"),
            "frequency",
            "monetary",
        )
    )


def _quarter_bounds() -> dict[str, Column]:
    """Last rank of the first three of four equal-frequency bins over ranks 1..n."""
    n = F.col("n")
    return {f"q{b}": F.floor(1 + (n - 1) * b / 4).cast("long") for b in (1, 2, 3)}


def _worst_first() -> dict[str, Column]:
    """Sort keys whose rising order puts the worst customers first."""
    return {
        "recency": -F.col("recency"),
        "frequency": F.col("frequency"),
        "monetary": F.col("monetary"),
    }


def _quartile_score(key: Column, cuts: str) -> Column:
    """4 for the first bin of the rank order down to 1 for the last."""

    def at_or_before(cut: Column) -> Column:
        value = key.cast("double")
        same = (value == cut["value"]) & (F.col("customer_id") <= cut["tie"])
        return (value < cut["value"]) | same

    score = F.lit(1)
    for bound, points in (("q3", 2), ("q2", 3), ("q1", 4)):
        score = F.when(at_or_before(F.col(cuts)[bound]), points).otherwise(score)
    return score


def rfm_quartile_score(rfm: DataFrame) -> DataFrame:
    """Quartile scores over unique ranks, 1 is best; ties go by customer id.

    Each metric needs only three (value, customer) pairs: they travel as one row, the
    customers are not joined by rank.
    """
    rfm = stage(rfm, "rfm")  # read for the ranks and again for the scores
    keys = _worst_first()
    cuts = rank_cutoffs(
        rfm, {f"_{name}": key for name, key in keys.items()}, "customer_id", _quarter_bounds()
    )
    scored = rfm.crossJoin(F.broadcast(cuts)).select(
        "customer_id",
        *METRICS,
        *[_quartile_score(key, f"_{name}").alias(f"{name[0]}_score") for name, key in keys.items()],
    )
    total = F.col("r_score") + F.col("f_score") + F.col("m_score")
    segment = scoring.score_text(F.col("r_score"), F.col("f_score"), F.col("m_score"))
    return (
        scored.withColumn("rfm_segment", segment)
        .withColumn("rfm_score", total)
        .withColumn("score", scoring.tier_low_is_best(F.col("rfm_score")))
    )


def rfm_quintile_segments(rfm: DataFrame) -> DataFrame:
    """Quintile scores by value, 5 is best, with a segment name and a tier."""
    rfm = stage(rfm, "rfm")  # read for the quantiles and again for the scores
    fifths = (2, 4, 6, 8)
    points = {m: {f"_{m}_{p}": p / 10 for p in fifths} for m in METRICS}
    row = rfm.crossJoin(F.broadcast(exact_quantiles(rfm, points)))

    def score(metric: str, low_is_best: bool) -> Column:
        cuts = [F.col(f"_{metric}_{p}") for p in fifths]
        return scoring.quantile_score(F.col(metric), cuts, low_is_best)

    scored = row.select(
        "customer_id",
        *METRICS,
        score("recency", True).alias("r_score"),
        score("frequency", False).alias("f_score"),
        score("monetary", False).alias("m_score"),
    )
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    return (
        scored.withColumn("rfm_segment", scoring.score_text(r, f, m))
        .withColumn("rfm_score", r + f + m)
        .withColumn("segment", scoring.segment_name(r, f))
        .withColumn("score", scoring.tier_high_is_best(F.col("rfm_score")))
    )


def shares(df: DataFrame, key: str) -> DataFrame:
    """Rows per key with their percentage, from counts of a few keys."""
    counts = df.groupBy(key).agg(F.count("*").alias("count"))
    total = counts.agg(F.sum("count").alias("_all"))
    percent = F.round(F.col("count") / F.col("_all") * 100, 1)
    return counts.crossJoin(F.broadcast(total)).withColumn("percent", percent).drop("_all")


def shares_within(df: DataFrame, group: str, key: str) -> DataFrame:
    """Rows per (group, key) with their percentage of the group."""
    counts = df.groupBy(group, key).agg(F.count("*").alias("count"))
    whole = F.sum("count").over(Window.partitionBy(group))
    return counts.withColumn("percent", F.round(F.col("count") / whole * 100, 1))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("count"))


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 20) -> DataFrame:
    """Equal-width bins of each column with counts and densities; empty bins count 0.

    A column with one value has one bin.
    """
    entries = [
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in columns
    ]
    values = df.select(F.inline(F.array(*entries))).where("value is not null")
    # one row per column
    spans = values.groupBy("metric").agg(
        F.min("value").alias("_lo"), F.max("value").alias("_hi"), F.count("*").alias("_n")
    )
    spans = stage(spans.withColumn("_width", (F.col("_hi") - F.col("_lo")) / bins), "spans")
    index = F.floor(F.try_divide(F.col("value") - F.col("_lo"), F.col("_width")))
    bucket = F.least(F.coalesce(index, F.lit(0)), F.lit(bins - 1)).cast("int")
    counts = (
        values.join(F.broadcast(spans), "metric")
        .groupBy("metric", bucket.alias("bin"))
        .agg(F.count("*").alias("count"))
    )
    last = F.when(F.col("_width") > 0, bins - 1).otherwise(0)
    every = spans.select("*", F.explode(F.sequence(F.lit(0), last)).alias("bin"))
    return every.join(F.broadcast(counts), ["metric", "bin"], "left").select(
        "metric",
        "bin",
        (F.col("_lo") + F.col("bin") * F.col("_width")).alias("bin_start"),
        F.coalesce("count", F.lit(0)).alias("count"),
        F.try_divide(F.coalesce("count", F.lit(0)), F.col("_n") * F.col("_width")).alias("density"),
    )
