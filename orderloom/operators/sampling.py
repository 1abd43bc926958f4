"""Repeatable splits and samples that do not depend on partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.operators.ordering import with_row_number


def hash_number(*keys: Column, seed: int = 42) -> Column:
    """A number below 2^32 from the keys, the same on every run and in every engine."""
    text = F.concat_ws("-", *[key.cast("string") for key in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def in_train_part(*keys: Column, percent: int = 80, seed: int = 42) -> Column:
    return hash_number(*keys, seed=seed) % 100 < percent


def exact_sample(df: DataFrame, key: str, fraction: float, seed: int = 42) -> DataFrame:
    """Exactly ``round(fraction * rows)`` rows, chosen by the hash of a unique key."""
    shuffled = with_row_number(
        df.withColumn("_hash", hash_number(F.col(key), seed=seed)), ["_hash", key], "_rn"
    )
    size = df.agg(F.round(F.count("*") * F.lit(fraction)).cast("long").alias("_size"))
    return shuffled.crossJoin(F.broadcast(size)).where("_rn <= _size").select(*df.columns)
