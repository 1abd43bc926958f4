"""Connected components of a graph of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.scratch import stage


def _neighbourhoods(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return both


def _star(both: DataFrame, large: bool) -> DataFrame:
    """One star step.  ``both`` has each edge in both directions, or downwards only."""
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = both.join(least, "u")
    if large:
        new = joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        pulled = joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = pulled.unionAll(least.where("m != u").select("u", F.col("m").alias("v")))
    return new.distinct()


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*"), F.sum(F.shiftright(F.xxhash64("u", "v"), 20)), F.bit_xor(F.xxhash64("v", "u"))
    ).first()
    return tuple(row)


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """Rows (node, component) for each node of a link; component is the least node in it.

    The number of edges never grows, and the steps end when they no longer change them:
    a logarithmic number of times in the length of the longest path.  The minimum of a
    neighbourhood combines before the shuffle; in the join of neighbours to their minimum
    a hub with a third of all edges is split by the skew join.  Each step is written to
    the shared folder, which cuts the lineage.
    """
    edges = links.select(
        F.greatest(left, right).alias("u"), F.least(left, right).alias("v")
    ).where("u != v")
    edges = stage(edges.distinct(), "links")
    seen = _fingerprint(edges)
    while seen[0]:
        larger = _star(_neighbourhoods(edges), large=True)
        edges = stage(_star(larger, large=False), "stars")
        now = _fingerprint(edges)
        if now == seen:
            break
        seen = now
    own = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return own.unionAll(roots).distinct()
