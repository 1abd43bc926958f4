"""Sessions of a key: events without a longer gap, whatever share of all rows a key has.

``session_window`` sorts all events of a key in one task.  Here the rows are
range-partitioned by key and time and written once.  Each range is cut at its gaps and
gives a row per session; only its first and its last session can go on in a neighbouring
range.  These edges, at most two rows per range, are chained over all ranges.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.operators.ordering import partition_of, sorted_copy
from orderloom.scratch import stage


def sessions(
    df: DataFrame,
    key: str,
    time: str,
    gap: str,
    sums: Mapping[str, Column],
    ties: Sequence[str] = (),
) -> DataFrame:
    """(key, session_start, session_end, sums): as ``session_window`` gives them.

    An event belongs to the session before it if it comes no more than ``gap`` after its
    last event; a session ends ``gap`` after its last event.  Rows without a time have no
    session, and the null key is a key.  ``ties`` are further sort columns: with them not
    even one instant of a key has to fit in one range.
    """
    reach = F.expr(f"INTERVAL {gap}")
    named = {f"_sum{i}": expr for i, expr in enumerate(sums.values())}
    events = df.where(F.col(time).isNotNull()).select(
        F.col(key).alias("_key"),
        F.col(time).alias("_time"),
        *[F.col(c).alias(f"_tie{i}") for i, c in enumerate(ties)],
        *[expr.alias(name) for name, expr in named.items()],
    )
    order = ["_key", "_time", *[f"_tie{i}" for i in range(len(ties))]]
    rows = sorted_copy(events, order, "sessions").withColumn("_part", partition_of())
    inside = Window.partitionBy("_part").orderBy("_at")

    def linked(key: Column, start: Column, before: Column) -> Column:
        same = before["key"].eqNullSafe(key) & before["end"].isNotNull()
        return F.coalesce(same & (start <= before["end"] + reach), F.lit(False))

    last_event = F.lag(F.struct(F.col("_key").alias("key"), F.col("_time").alias("end"))).over(inside)
    begins = (~linked(F.col("_key"), F.col("_time"), last_event)).cast("long")
    local = (
        rows.withColumn("_begins", begins)
        .withColumn("_no", F.sum("_begins").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("_part", "_no")
        .agg(
            F.min("_key").alias("_key"),
            F.min("_time").alias("_start"),
            F.max("_time").alias("_end"),
            *[F.sum(name).alias(name) for name in named],
        )
    )
    whole = Window.partitionBy("_part")
    local = stage(local.withColumn("_last", F.max("_no").over(whole)), "range-sessions")
    is_edge = (F.col("_no") == 1) | (F.col("_no") == F.col("_last"))

    # at most two rows per range
    along = Window.orderBy("_part", "_no")
    edge = local.where(is_edge)
    edge_before = F.lag(F.struct(F.col("_key").alias("key"), F.col("_end").alias("end"))).over(along)
    chained = (
        edge.withColumn("_begins", (~linked(F.col("_key"), F.col("_start"), edge_before)).cast("long"))
        .withColumn("_chain", F.sum("_begins").over(along.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("_chain")
        .agg(
            F.min("_key").alias("_key"),
            F.min("_start").alias("_start"),
            F.max("_end").alias("_end"),
            *[F.sum(name).alias(name) for name in named],
        )
    )
    columns = ["_key", "_start", "_end", *named]
    found = local.where(~is_edge).select(*columns).unionAll(chained.select(*columns))
    return found.select(
        F.col("_key").alias(key),
        F.col("_start").alias("session_start"),
        (F.col("_end") + reach).alias("session_end"),
        *[F.col(own).alias(name) for own, name in zip(named, sums)],
    )
