"""The shop's menu: which category an item name belongs to."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

MENU = T.StructType(
    [
        T.StructField("position", T.IntegerType()),
        T.StructField("item_name", T.StringType()),
        T.StructField("item_category", T.StringType()),
    ]
)


def read_menu(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MENU).option("header", True).csv(path)
