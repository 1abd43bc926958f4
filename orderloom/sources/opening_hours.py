"""Opening hours: dated exceptions, closures without times, one row per weekday."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.functions.calendar import weekday_name

OPENING_HOURS = T.StructType(
    [
        T.StructField("date", T.StringType()),
        T.StructField("open_time", T.IntegerType()),
        T.StructField("close_time", T.IntegerType()),
        T.StructField("special_note", T.StringType()),
    ]
)


def read_opening_hours(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(OPENING_HOURS).option("header", True).csv(path)


def holiday_hours(orders: DataFrame) -> DataFrame:
    """Opening hours for the order tables at hand, which come without such a file.

    Over the years the orders span: closed on 25 December, short hours on 26 January,
    and the usual hours of each weekday.
    """
    span = orders.agg(
        F.to_date(F.min("date_created")).alias("lo"), F.to_date(F.max("date_created")).alias("hi")
    )
    day = F.col("day")
    days = span.select(F.explode(F.sequence("lo", "hi")).alias("day"))
    christmas = (F.month(day) == 12) & (F.dayofmonth(day) == 25)
    january = (F.month(day) == 1) & (F.dayofmonth(day) == 26)
    special = days.where(christmas | january).select(
        day.cast("string").alias("date"),
        F.when(january, 700).alias("open_time"),
        F.when(january, 1400).alias("close_time"),
        F.when(january, "Short day").otherwise("Closed").alias("special_note"),
    )
    first = days.groupBy(weekday_name(day).alias("name"), F.weekday(day).alias("n")).agg(
        F.count("*").alias("seen")
    )
    usual = first.select(
        F.concat(F.lit("normal_"), "name").alias("date"),
        F.when(F.col("n") < 5, 600).otherwise(700).alias("open_time"),
        F.lit(1600).alias("close_time"),
        F.lit(None).cast("string").alias("special_note"),
    )
    return special.unionByName(usual)
