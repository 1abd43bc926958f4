"""Named queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.workload.shop import Shop, shop

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round float columns: engines add floats in different orders."""
    return df.select(
        *[
            F.round(F.col(f"`{f.name}`"), digits).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def query(name: str, oracle: str | None = None, digits: int | None = 6):
    """Register ``fn(shop) -> DataFrame`` under ``name``."""

    def register(fn: Callable[[Shop], DataFrame]) -> Callable[[Shop], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            found = fn(shop(spark, sf_dir))
            return found if digits is None else rounded(found, digits)

        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register
