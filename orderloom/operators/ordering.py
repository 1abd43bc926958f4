"""Positions in a global order, without a window over the whole table.

A window without partition keys runs in one task.  Here the rows are range-partitioned
by the sort columns, written once, and numbered per partition; the sizes of the
partitions (one row each) give the offsets.  The written copy fixes the partition of
each row, so a lost executor cannot shift the numbering.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.scratch import stage

_POSITION_BITS = 33  # monotonically_increasing_id: partition above, row below


def sorted_copy(df: DataFrame, order: Sequence[str | Column], label: str) -> DataFrame:
    """A written copy in global order with the place of each row in ``_at``."""
    return stage(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), label)


def partition_of() -> Column:
    """The range a row of a sorted copy was written in."""
    return F.shiftright("_at", _POSITION_BITS)


def with_prefix(
    df: DataFrame, order: Sequence[str | Column], amounts: Mapping[str, str], label: str = "sorted"
) -> DataFrame:
    """Add running totals in the global order.

    ``amounts`` maps an output column to the column it sums; the total excludes the row
    itself.  ``order`` should be unique per row: then no value, however frequent, has to
    fit in one partition.
    """
    rows = sorted_copy(df, order, label).withColumn("_part", partition_of())
    sums = rows.groupBy("_part").agg(
        *[F.sum(source).alias(f"_sum_{out}") for out, source in amounts.items()]
    )
    # one row per range partition, at most spark.sql.shuffle.partitions of them
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        "_part",
        *[
            F.coalesce(F.sum(f"_sum_{out}").over(before), F.lit(0)).alias(f"_off_{out}")
            for out in amounts
        ],
    )
    inside = (
        Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    )
    local = rows.select(
        "*",
        *[
            F.coalesce(F.sum(source).over(inside), F.lit(0)).alias(f"_in_{out}")
            for out, source in amounts.items()
        ],
    )
    joined = local.join(F.broadcast(offsets), "_part")
    return joined.select(
        *df.columns,
        *[(F.col(f"_off_{out}") + F.col(f"_in_{out}")).alias(out) for out in amounts],
    )


def with_row_number(df: DataFrame, order: Sequence[str | Column], out: str) -> DataFrame:
    """1-based position in the global order."""
    counted = with_prefix(df.withColumn("_one", F.lit(1)), order, {out: "_one"}, "row-number")
    return counted.withColumn(out, F.col(out) + 1).drop("_one")


def _long_form(df: DataFrame, keys: Mapping[str, Column], *carry: str) -> DataFrame:
    """Rows (metric, value, carried columns) of several columns, so one sort serves all."""
    entries = [
        F.struct(F.lit(name).alias("metric"), key.cast("double").alias("value"))
        for name, key in keys.items()
    ]
    return df.select(*carry, F.inline(F.array(*entries))).where("value is not null")


def rank_cutoffs(
    df: DataFrame, keys: Mapping[str, Column], tie_break: str, ranks: Mapping[str, Column]
) -> DataFrame:
    """One row with, per sort key, the (value, tie) pair at each wanted 1-based rank.

    ``ranks`` are expressions over ``n``, the number of rows.  The result has a struct
    column per key with a struct field per rank.
    """
    numbered = with_row_number(
        _long_form(df, keys, tie_break), ["metric", "value", tie_break], "rn"
    )
    # one row per sort key
    spans = numbered.groupBy("metric").agg(F.min("rn").alias("first"), F.count("*").alias("n"))
    pair = F.struct(F.col("value"), F.col(tie_break).alias("tie"))
    at = F.col("rn") - F.col("first") + 1
    placed = numbered.join(F.broadcast(spans), "metric")
    found = [
        F.max(F.when((F.col("metric") == key) & (at == rank), pair)).alias(f"{key}/{name}")
        for key in keys
        for name, rank in ranks.items()
    ]
    row = placed.agg(*found)
    return row.select(
        *[
            F.struct(*[F.col(f"`{key}/{name}`").alias(name) for name in ranks]).alias(key)
            for key in keys
        ]
    )


def _counted_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values per column with their count and the number of smaller rows.

    A frequent value is one row here, however many rows have it.
    """
    counts = (
        _long_form(df, {c: F.col(c) for c in columns})
        .groupBy("metric", "value")
        .agg(F.count("*").alias("cnt"))
    )
    walked = with_prefix(counts, ["metric", "value"], {"_before": "cnt"}, "value-counts")
    # one row per column
    spans = walked.groupBy("metric").agg(F.min("_before").alias("_first"), F.sum("cnt").alias("n"))
    return walked.join(F.broadcast(spans), "metric").select(
        "metric", "value", "cnt", (F.col("_before") - F.col("_first")).alias("before"), "n"
    )


def exact_quantiles(df: DataFrame, probabilities: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """One row of exact, linearly interpolated quantiles.

    ``probabilities`` maps a column to {output name: probability}.
    """
    placed = _counted_values(df, list(probabilities))
    wanted = [
        (column, name, float(p))
        for column, points in probabilities.items()
        for name, p in points.items()
    ]

    def place(p: float) -> Column:
        return (F.col("n") - 1) * F.lit(p)

    def at(column: str, position: Column) -> Column:
        covers = (F.col("before") <= position) & (position < F.col("before") + F.col("cnt"))
        return F.max(F.when((F.col("metric") == column) & covers, F.col("value")))

    picks = []
    for column, name, p in wanted:
        fraction = place(p) - F.floor(place(p))
        picks += [
            at(column, F.floor(place(p))).alias(f"_lo_{name}"),
            at(column, F.ceil(place(p))).alias(f"_hi_{name}"),
            F.max(F.when(F.col("metric") == column, fraction)).alias(f"_fr_{name}"),
        ]
    row = placed.agg(*picks)
    return row.select(
        *[
            (
                F.col(f"_lo_{name}")
                + (F.col(f"_hi_{name}") - F.col(f"_lo_{name}")) * F.col(f"_fr_{name}")
            ).alias(name)
            for _, name, _ in wanted
        ]
    )


def average_ranks(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Each distinct value of each column with its average rank over ties."""
    rank = F.col("before") + (F.col("cnt") + 1) / 2
    return _counted_values(df, columns).select("metric", "value", rank.alias("rank"))


def spearman(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rank correlation of each pair of columns as rows (left, right, rho, n).

    ``ml.stat.Correlation`` keeps all rows of one tied value in memory; here ties are
    counted instead.
    """
    ranked = stage(df.select(*columns).dropna(), "spearman")
    ranks = average_ranks(ranked, columns)
    for column in columns:
        own = ranks.where(F.col("metric") == column).select(
            F.col("value").alias("_value"), F.col("rank").alias(f"_rank_{column}")
        )
        ranked = ranked.join(own, F.col(column).cast("double") == F.col("_value")).drop("_value")
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    row = ranked.agg(
        F.count("*").alias("n"),
        *[
            F.corr(f"_rank_{a}", f"_rank_{b}").alias(f"rho_{i}")
            for i, (a, b) in enumerate(pairs)
        ],
    )
    found = F.array(
        *[
            F.struct(F.lit(a).alias("left"), F.lit(b).alias("right"), F.col(f"rho_{i}").alias("rho"))
            for i, (a, b) in enumerate(pairs)
        ]
    )
    return row.select(F.inline(found), "n")


def significance(correlations: DataFrame, z: float = 1.959963984540054) -> DataFrame:
    """Add the t statistic and a large-sample two-sided flag at 5 %."""
    rho, n = F.col("rho"), F.col("n")
    t = F.try_divide(rho * F.sqrt(n - 2), F.sqrt(1 - rho * rho))
    return correlations.withColumn("t_stat", t).withColumn("significant", F.abs(t) > z)


def roc_points(scored: DataFrame, score: str, label: str) -> DataFrame:
    """One ROC point per distinct score, from the highest score down."""
    by_score = scored.groupBy(score).agg(
        F.sum(F.col(label).cast("long")).alias("pos"),
        F.sum(1 - F.col(label).cast("long")).alias("neg"),
    )
    walked = with_prefix(
        by_score, [F.col(score).desc()], {"pos_before": "pos", "neg_before": "neg"}, "roc"
    )
    totals = by_score.agg(F.sum("pos").alias("all_pos"), F.sum("neg").alias("all_neg"))
    return walked.crossJoin(F.broadcast(totals)).select(
        F.col(score).alias("threshold"),
        F.try_divide(F.col("neg_before") + F.col("neg"), F.col("all_neg")).alias("fpr"),
        F.try_divide(F.col("pos_before") + F.col("pos"), F.col("all_pos")).alias("tpr"),
    )
