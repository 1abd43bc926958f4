"""Table profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.operators.sketches import distinct_counts


def profile(df: DataFrame, exact: bool = False) -> DataFrame:
    """One row per column: rows, nulls, distinct values, smallest, greatest, mean.

    One pass over the table with estimated distinct counts; ``exact`` counts them in a
    second pass, in which a 64-bit hash stands for a value.
    """
    aggregates, entries = [F.count("*").alias("_rows")], []
    for i, field in enumerate(df.schema.fields):
        column = F.col(f"`{field.name}`")
        numeric = isinstance(field.dataType, T.NumericType)
        mean = F.avg(column) if numeric else F.lit(None).cast("double")
        aggregates += [
            F.count(column).alias(f"_n{i}"),
            (F.lit(0) if exact else F.approx_count_distinct(column)).alias(f"_d{i}"),
            F.min(column).cast("string").alias(f"_lo{i}"),
            F.max(column).cast("string").alias(f"_hi{i}"),
            F.first(mean).alias(f"_m{i}") if not numeric else mean.alias(f"_m{i}"),
        ]
        entries.append(
            F.struct(
                F.lit(field.name).alias("column"),
                F.lit(field.dataType.simpleString()).alias("type"),
                F.col("_rows").alias("rows"),
                (F.col("_rows") - F.col(f"_n{i}")).alias("nulls"),
                F.col(f"_d{i}").alias("distinct_values"),
                F.col(f"_lo{i}").alias("min_value"),
                F.col(f"_hi{i}").alias("max_value"),
                F.col(f"_m{i}").alias("mean"),
            )
        )
    found = df.agg(*aggregates).select(F.inline(F.array(*entries)))
    if not exact:
        return found
    counts = distinct_counts(df, df.columns).withColumnRenamed("distinct_values", "_exact")
    distinct = F.coalesce("_exact", F.lit(0)).alias("distinct_values")
    joined = found.join(F.broadcast(counts), "column", "left")  # a row per column
    return joined.select(*[distinct if c == "distinct_values" else c for c in found.columns])


def top_values(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    counts = df.groupBy(F.col(column).cast("string").alias("value")).agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), F.asc("value")).limit(n).select(
        F.lit(column).alias("column"), "value", "count"
    )


def quantiles(df: DataFrame, columns: Sequence[str], accuracy: int = 10_000) -> DataFrame:
    """Estimated quartiles of numeric columns in one pass."""
    points = [0.0, 0.25, 0.5, 0.75, 1.0]
    estimates = df.agg(
        *[F.percentile_approx(c, points, accuracy).alias(f"_{c}") for c in columns]
    )
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            *[
                F.get(F.col(f"_{c}"), F.lit(i)).cast("double").alias(name)
                for i, name in enumerate(["min", "q25", "median", "q75", "max"])
            ],
        )
        for c in columns
    ]
    return estimates.select(F.inline(F.array(*entries)))
