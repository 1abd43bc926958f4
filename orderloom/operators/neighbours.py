"""The next event of the same customer, whatever share of all rows a customer has."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.operators.ordering import partition_of, sorted_copy


def with_next(df: DataFrame, key: str, order: Sequence[str], out: str) -> DataFrame:
    """Add the first order column of the next row within ``key``, as a plain ``lead`` would.

    ``order`` is unique within the key; nulls come first in it, and the null key is a key.
    The rows are range-partitioned by key and order and written once.  Inside a range the
    next row is the next in file order; the last row of a range looks at the first row of
    the following range, of which there is one row per range.  So a key of any size is
    spread over as many ranges as it fills, and no list of large keys is needed.
    """
    first = order[0]
    rows = sorted_copy(df, [key, *order], "next-event").withColumn("_part", partition_of())
    head = F.struct(F.col(key).alias("key"), F.col(first).alias("at"))
    # one row per range
    heads = rows.groupBy("_part").agg(F.min_by(head, "_at").alias("_head"))
    beyond = heads.select("_part", F.lead("_head").over(Window.orderBy("_part")).alias("_beyond"))
    inside = Window.partitionBy("_part").orderBy("_at")
    after = F.coalesce(F.lead(head).over(inside), F.col("_beyond"))
    joined = rows.join(F.broadcast(beyond), "_part").withColumn("_next", after)
    return joined.select(
        *df.columns, F.when(F.col("_next.key").eqNullSafe(F.col(key)), F.col("_next.at")).alias(out)
    )
