"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.scratch import stage

MAX_RATE = 500.0  # a larger mean is split into equal parts that are drawn apart


def unit(*parts: Column) -> Column:
    """A number in (0, 1) drawn by the md5 of the parts: 52 bits, so exact in a double."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    high = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double")
    return (high + F.lit(0.5)) / F.lit(float(2**52))


def poisson_count(u: Column, rate: Column) -> Column:
    """Smallest k with u <= P(X <= k) for X ~ Poisson(rate), as an expression.

    The distribution is walked once per row: P(X = k) follows from P(X = k - 1), and the
    walk ends by k = rate + 12 * sqrt(rate) + 40, beyond which less than 2**-52 is left.
    """
    last = F.ceil(rate + 12 * F.sqrt(rate) + 40).cast("int")
    start = F.struct(
        F.exp(-rate).alias("p"), F.exp(-rate).alias("below"), F.lit(0).cast("int").alias("k")
    )

    def step(at: Column, k: Column) -> Column:
        p = at["p"] * rate / k
        return F.when(u <= at["below"], at).otherwise(
            F.struct(p.alias("p"), (at["below"] + p).alias("below"), k.alias("k"))
        )

    return F.aggregate(F.sequence(F.lit(1), last), start, step, lambda at: at["k"])


def source_rates(
    docs: DataFrame, weights: Mapping[str, float] | None, source: str = "source"
) -> DataFrame:
    """Mean number of copies of a document of each source.

    The copies of a source should be its share of the weights times the number of all
    documents.  Without weights all sources weigh the same.  With weights, sources that
    are not named get rate 0; the null source is named by None.
    """
    sizes = docs.groupBy(F.col(source).alias("_source")).agg(F.count("*").alias("_n"))
    if weights is None:
        weighed = sizes.withColumn("_w", F.lit(1.0))
    else:
        chosen = F.lit(0.0)
        for name, weight in weights.items():
            if weight < 0:
                raise ValueError("weights must not be negative")
            chosen = F.when(F.col("_source").eqNullSafe(F.lit(name)), F.lit(float(weight))).otherwise(
                chosen
            )
        weighed = sizes.withColumn("_w", chosen)
    # one row
    total = weighed.agg(F.sum("_n").alias("_all"), F.sum("_w").alias("_weights"))
    share = F.coalesce(F.try_divide(F.col("_w"), F.col("_weights")), F.lit(0.0))
    return weighed.crossJoin(F.broadcast(total)).select(
        "_source", (share * F.col("_all") / F.col("_n")).alias("_rate")
    )


def mix_sources(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    key: str = "doc_id",
    source: str = "source",
    seed: int = 17,
) -> DataFrame:
    """Replicate documents so that sources meet their target weights, in a random order.

    A document appears k times, k drawn from the Poisson distribution whose mean is its
    source's rate by a number that depends on key and seed only.  The result has the
    columns of ``docs`` and ``_copy`` (0 to k - 1), ``_rate`` and ``_order``, each left out
    if ``docs`` has a column of that name; it is range partitioned and sorted by the order,
    a hash of seed, key and copy.  Rows that repeat a key get the same k.  A null key or
    source is a value like others.  Rates have no upper limit: beyond MAX_RATE a count is
    the sum of draws of equal rates.  Empty tables give no rows.

    The rates, one row per source, are written first, so that their size is known when
    the join is planned: a small table is broadcast and the documents stay where they are,
    else a source with a third of all rows is split by the skew join.  The one wide shuffle
    is the global order itself: as the order is even in (0, 1), the ranges are known without
    a sample of it, so copies are drawn once.  There are spark.sql.shuffle.partitions ranges.
    """
    rates = stage(source_rates(docs, weights, source), "source-rates")
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_doc"))
    of, own = F.col(f"_doc.`{source}`"), F.col(f"_doc.`{key}`")
    rated = packed.join(rates, of.eqNullSafe(F.col("_source"))).drop("_source")
    parts = F.greatest(F.ceil(F.col("_rate") / F.lit(MAX_RATE)), F.lit(1)).cast("int")
    each = F.col("_rate") / parts
    draws = F.transform(
        F.sequence(F.lit(1), parts),
        lambda i: poisson_count(unit(F.lit(seed), own, i), each),
    )
    drawn = F.aggregate(draws, F.lit(0), lambda a, b: a + b)
    counted = rated.withColumn("_k", F.when(F.col("_rate") > 0, drawn).otherwise(0))
    copies = counted.where("_k > 0").withColumn(
        "_copy", F.explode(F.sequence(F.lit(0), F.col("_k") - 1))
    )
    order = unit(F.lit(f"order{seed}"), own, F.col("_copy"))
    ordered = copies.withColumn("_order", order)
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.least(F.floor(F.col("_order") * n), F.lit(n - 1)).cast("int")
    mixed = ordered.repartitionById(n, part).sortWithinPartitions("_order", own, "_copy")
    added = [c for c in ("_copy", "_rate", "_order") if c not in docs.columns]
    return mixed.select("_doc.*", *added)
