"""Rendezvous hashing of record keys over weighted shards."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import whole_text
from orderloom.operators.ordering import with_prefix
from orderloom.scratch import stage

OVERHEAD = 16  # bytes that a record takes besides its text


def key_text(key: str) -> Column:
    """The key as text; a null key has a text of its own."""
    return F.coalesce(F.concat(F.lit("k"), F.col(key).cast("string")), F.lit("null"))


def rendezvous(key: Column, weights: Sequence[float], seed: int = 0) -> Column:
    """Shard whose score for the key is greatest.

    Each shard scores log(u) / weight, with u in (0, 1) drawn by the hash of seed, shard
    and key.  A shard wins in proportion to its weight, and since scores do not depend on
    the other shards, adding or growing a shard moves records into that shard only.
    Equal scores go to the lower shard.  Shards of weight 0 get nothing.
    """
    if not any(w > 0 for w in weights) or any(w < 0 for w in weights):
        raise ValueError("weights must not be negative, and one must be positive")
    scores = []
    for shard, weight in enumerate(weights):
        if weight > 0:
            top = F.shiftrightunsigned(
                F.xxhash64(F.concat(F.lit(f"{seed}:{shard}:"), key)), 11
            )
            u = (top + F.lit(0.5)) / F.lit(float(2**53))
            score = F.log(u) / F.lit(float(weight))
            scores.append(F.struct(score.alias("score"), F.lit(-shard).alias("minus_shard")))
    best = scores[0] if len(scores) == 1 else F.greatest(*scores)
    return (-best["minus_shard"]).cast("int")


def assign(
    df: DataFrame, key: str, weights: Sequence[float], out: str = "shard", seed: int = 0
) -> DataFrame:
    """Add the shard of each row.  Rows with equal keys, null ones too, share a shard."""
    return df.withColumn(out, rendezvous(key_text(key), weights, seed))


def shard_documents(
    docs: DataFrame, shards: int = 40, key: str = "doc_id", text: str = "text", seed: int = 0
) -> DataFrame:
    """Shard, place in the shard, and shard with one more, of each document.

    Sizes are the UTF-8 bytes of the text (0 if null) plus 16.  Slots count from 0 without
    gaps in each shard, by key (nulls first), then size and checksum; rows equal in all of
    these are in any order.  Empty tables give no rows; other columns are not read.

    The slots come from one range-partitioned sort of narrow rows, so a shard of any size
    spreads over many tasks.
    """
    own = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    raw = F.encode(whole_text(), "UTF-8")
    keyed = own.select(
        "doc_id",
        (F.octet_length(whole_text()) + OVERHEAD).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous(key_text("doc_id"), [1.0] * shards, seed).alias("shard"),
        rendezvous(key_text("doc_id"), [1.0] * (shards + 1), seed).alias("grown_shard"),
        F.monotonically_increasing_id().alias("_row"),
    )
    narrow = stage(keyed, "shard-keys").withColumn("_one", F.lit(1))
    placed = with_prefix(
        narrow, ["shard", "doc_id", "size", "text_crc32", "_row"], {"_place": "_one"}, "shards"
    )
    # one row per shard
    first = placed.groupBy("shard").agg(F.min("_place").alias("_first"))
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        "law",
        "shard",
        (F.col("_place") - F.col("_first")).alias("slot"),
        "grown_shard",
    )
