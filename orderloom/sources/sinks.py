"""Writing results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, table: str, mode: str = "errorifexists") -> None:
    """A warehouse table; the default refuses to replace one, ``overwrite`` replaces."""
    df.write.mode(mode).saveAsTable(table)


def append_table(df: DataFrame, table: str) -> None:
    df.write.mode("append").saveAsTable(table)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_orders_by_month(
    orders: DataFrame, path: str, mode: str = "overwrite", slices: int = 16
) -> None:
    """Order table in month folders, so period jobs read only their months.

    The months are spread over tasks by month and order, not by month alone: one busy
    month does not end up in one task.  ``slices`` is the number of tasks a month may
    spread over: about the gigabytes of the largest month.
    """
    month = F.date_format("date_created", "yyyy-MM")
    spread = F.pmod(F.xxhash64("order_id"), F.lit(slices))
    (
        orders.withColumn("order_month", month)
        .repartition("order_month", spread)
        .write.mode(mode)
        .partitionBy("order_month")
        .parquet(path)
    )


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Name a frame for SQL users."""
    df.createOrReplaceTempView(name)
    return df
