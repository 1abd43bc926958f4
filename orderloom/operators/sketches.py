"""Table profiles from sketches that can be stored and merged.

One pass over a table makes, per column, a HyperLogLog sketch of its values, a KLL sketch
if it holds numbers, and a frequent-items sketch.  A sketch has a bounded size, whatever
the number of rows.  Sketches of slices of a table (months, files, days of arrival) are
rows of an ordinary table; merging them gives the profile of the whole without reading
the slices again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.scratch import stage

HLL_BITS = 14
TOP_ITEMS = 4096
LONGEST = 64

# Stated errors: three standard errors of a distinct count as a share of it, the error of a
# quantile's rank (KLL with its standard size, 99 %), and that of a frequent item's count,
# both as a share of the rows.
DISTINCT_ERROR = 3 * 1.04 / 2 ** (HLL_BITS / 2)
RANK_ERROR = 0.0166
COUNT_ERROR = 3.5 / TOP_ITEMS


def _is_number(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


def value_label(column: Column, kind: T.DataType) -> Column:
    """Text of a value; a long one as its beginning and a hash, so different ones differ."""
    text = F.to_json(F.struct(column.alias("v"))) if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)) else column.cast("string")
    short = F.concat(F.substring(text, 1, 40), F.lit("..."), F.hex(F.xxhash64(text)))
    return F.when(F.length(text) > LONGEST, short).otherwise(text)


def sketch(df: DataFrame, *by: str) -> DataFrame:
    """One row per column (and slice, if ``by`` names its columns) with its sketches."""
    aggregates, entries = [F.count("*").alias("_rows")], []
    for i, field in enumerate(f for f in df.schema.fields if f.name not in by):
        column = F.col(f"`{field.name}`")
        hashed = F.when(column.isNotNull(), F.xxhash64(column))
        aggregates += [
            F.count(column).alias(f"_n{i}"),
            F.hll_sketch_agg(hashed, HLL_BITS).alias(f"_d{i}"),
            F.call_function(
                "approx_top_k_accumulate", value_label(column, field.dataType), F.lit(TOP_ITEMS)
            ).alias(f"_t{i}"),
        ]
        ranks = F.lit(None).cast("binary")
        if _is_number(field.dataType):
            aggregates.append(F.kll_sketch_agg_double(column.cast("double")).alias(f"_q{i}"))
            ranks = F.when(F.col(f"_n{i}") > 0, F.col(f"_q{i}"))
        entries.append(
            F.struct(
                F.lit(field.name).alias("column"),
                F.lit(field.dataType.simpleString()).alias("type"),
                F.col("_rows").alias("rows"),
                (F.col("_rows") - F.col(f"_n{i}")).alias("nulls"),
                F.col(f"_d{i}").alias("distinct_sketch"),
                ranks.alias("rank_sketch"),
                F.col(f"_t{i}").alias("top_sketch"),
            )
        )
    return df.groupBy(*by).agg(*aggregates).select(*by, F.inline(F.array(*entries)))


def merge(sketches: DataFrame, *by: str) -> DataFrame:
    """Sketches of slices as those of their union, per column (and coarser slice)."""
    return sketches.groupBy(*by, "column", "type").agg(
        F.sum("rows").alias("rows"),
        F.sum("nulls").alias("nulls"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.when(F.count("rank_sketch") > 0, F.kll_merge_agg_double("rank_sketch")).alias("rank_sketch"),
        F.call_function("approx_top_k_combine", F.col("top_sketch"), F.lit(TOP_ITEMS)).alias("top_sketch"),
    )


def estimates(sketches: DataFrame, *by: str, top: int = 10) -> DataFrame:
    """What the sketches say: distinct values, quartiles, the most frequent values."""
    points = F.array(*[F.lit(p) for p in (0.0, 0.25, 0.5, 0.75, 1.0)])
    number = F.col("rank_sketch").isNotNull() & (F.col("rows") > F.col("nulls"))
    quartiles = F.when(number, F.kll_sketch_get_quantile_double("rank_sketch", points))
    items = F.filter(
        F.call_function("approx_top_k_estimate", F.col("top_sketch"), F.lit(top + 1)),
        lambda e: e["item"].isNotNull(),
    )
    return sketches.select(
        *by,
        "column",
        "type",
        "rows",
        "nulls",
        F.hll_sketch_estimate("distinct_sketch").alias("distinct_estimate"),
        quartiles.alias("quartiles"),
        F.slice(items, 1, top).alias("top_values"),
    )


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact (column, distinct_values): a 64-bit hash stands for a value.

    Each row is read once and gives a hash per column; equal ones meet before the shuffle.
    """
    return (
        _hashes(df, columns)
        .groupBy("column", "hash")
        .agg(F.lit(1).alias("_one"))
        .groupBy("column")
        .agg(F.count("*").alias("distinct_values"))
    )


def _hashes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    entries = [
        F.when(
            F.col(f"`{c}`").isNotNull(),
            F.struct(F.lit(i).alias("column"), F.xxhash64(F.col(f"`{c}`")).alias("hash")),
        )
        for i, c in enumerate(columns)
    ]
    named = F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("column") + 1)
    present = F.filter(F.array(*entries), lambda e: e.isNotNull())
    return df.select(F.inline(present)).withColumn("column", named)


def check_estimates(df: DataFrame, found: DataFrame) -> DataFrame:
    """Per column the exact figures, and whether each estimate is within its stated error.

    ``found`` are the ``estimates`` of the table.  The exact side counts every value.
    """
    found = stage(found, "estimates")  # a row per column, read several times
    fields = df.schema.fields
    numbers = [f.name for f in fields if _is_number(f.dataType)]
    exact = distinct_counts(df, df.columns)

    # ranks of the estimated quartiles: values below and values up to each
    row = found.where("quartiles is not null").agg(
        F.map_from_entries(F.collect_list(F.struct("column", "quartiles"))).alias("_q")
    )
    counts = []
    for i, c in enumerate(numbers):
        value = F.col(f"`{c}`").cast("double")
        for p in range(5):
            mark = F.get(F.try_element_at(F.col("_q"), F.lit(c)), F.lit(p))
            counts += [
                F.count_if(value < mark).alias(f"_b{i}_{p}"),
                F.count_if(value <= mark).alias(f"_u{i}_{p}"),
            ]
    ranked = None
    if numbers:
        sums = df.crossJoin(F.broadcast(row)).agg(*counts)
        entries = [
            F.struct(
                F.lit(c).alias("column"),
                F.array(
                    *[
                        F.struct(F.col(f"_b{i}_{p}").alias("below"), F.col(f"_u{i}_{p}").alias("upto"))
                        for p in range(5)
                    ]
                ).alias("ranks"),
            )
            for i, c in enumerate(numbers)
        ]
        ranked = sums.select(F.inline(F.array(*entries)))

    # true counts of the estimated top values
    labels = F.array(
        *[
            F.struct(F.lit(f.name).alias("column"), value_label(F.col(f"`{f.name}`"), f.dataType).alias("item"))
            for f in fields
        ]
    )
    wanted = found.select("column", F.inline("top_values"))
    true_counts = (
        df.select(F.inline(labels))
        .join(F.broadcast(wanted.select("column", "item")), ["column", "item"])
        .groupBy("column", "item")
        .agg(F.count("*").alias("_true"))
    )
    worst = (
        wanted.join(true_counts, ["column", "item"], "left")
        .groupBy("column")
        .agg(F.max(F.abs(F.col("count") - F.coalesce("_true", F.lit(0)))).alias("_off"))
    )

    joined = found.join(F.broadcast(exact), "column", "left").join(F.broadcast(worst), "column", "left")
    if ranked is not None:
        joined = joined.join(F.broadcast(ranked), "column", "left")
    else:
        joined = joined.withColumn("ranks", F.lit(None).cast("array<struct<below:bigint,upto:bigint>>"))
    present = F.col("rows") - F.col("nulls")
    true = F.coalesce("distinct_values", F.lit(0))
    points = F.array(*[F.lit(p) for p in (0.0, 0.25, 0.5, 0.75, 1.0)])

    def near(rank: Column, p: Column) -> Column:
        low, high = rank["below"] / present, rank["upto"] / present
        return (low <= p + RANK_ERROR) & (high >= p - RANK_ERROR)

    in_order = F.forall(F.zip_with("ranks", points, near), lambda ok: ok)
    return joined.select(
        "column",
        "rows",
        "nulls",
        true.alias("distinct_values"),
        (F.abs(F.col("distinct_estimate") - true) <= F.greatest(true * DISTINCT_ERROR, F.lit(0.5))).alias(
            "distinct_within"
        ),
        F.when(F.col("quartiles").isNotNull(), in_order).alias("quartiles_within"),
        (F.coalesce("_off", F.lit(0)) <= present * COUNT_ERROR).alias("top_within"),
    )
