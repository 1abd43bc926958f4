"""The raw order table: one row per order, the cart as JSON text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

RAW_ORDERS = T.StructType(
    [
        T.StructField("order_id", T.LongType(), False),
        T.StructField("customer_id", T.LongType(), False),
        T.StructField("ip_addr", T.StringType()),
        T.StructField("date_created", T.TimestampNTZType(), False),
        T.StructField("date_paid", T.TimestampNTZType()),
        T.StructField("total", T.LongType()),
        T.StructField("status", T.IntegerType()),
        T.StructField("items", T.StringType()),
    ]
)


def read_raw_orders(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.schema(RAW_ORDERS).format(fmt).load(path)


def read_tables(spark: SparkSession, root: str, names: list[str]) -> dict[str, DataFrame]:
    """A set of Parquet tables under one folder, by name."""
    return {name: spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet") for name in names}
