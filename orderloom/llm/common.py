"""Helpers of the operators: tables, row ids, fixed-size counts and bitmaps."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.scratch import stage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text, a null one as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def staged_with_row(df: DataFrame, label: str, row: str = "_row") -> DataFrame:
    """A written copy with an id per row; written, so that the ids stay as they are."""
    return stage(df.withColumn(row, F.monotonically_increasing_id()), label)


def least_hashed(df: DataFrame, hashed: Column, most: int, total: int) -> DataFrame:
    """The ``most`` rows with the least hash; ``total`` is the number of rows of ``df``.

    Of a large table only the rows with a hash below eight times the share wanted are
    compared, so that what meets in one task is bounded, however many tasks there were.
    """
    wide = 1 << 30
    bound = wide if total <= 8 * most else -(-wide * 8 * most // total)
    near = df.withColumn("_hash", F.pmod(hashed, F.lit(wide))).where(F.col("_hash") < bound)
    return near.orderBy("_hash", *df.columns).limit(most).drop("_hash")


@contextmanager
def small_batches(spark: SparkSession, most: int = 8 << 20) -> Iterator[None]:
    """Jobs that run inside get Arrow batches of at most ``most`` bytes, for long texts."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, most)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def summed_counts(
    df: DataFrame, count: Callable[[pa.RecordBatch, np.ndarray], None], cells: int
) -> np.ndarray:
    """Add up counts over all rows in an array of fixed size.

    Each task adds its batches to one array of ``cells`` entries with ``count`` and sends
    it in pieces; the pieces are added batch by batch, so no task holds more than one
    array besides its input, and the driver gets one array.
    """
    pieces = min(64, cells)
    width = -(-cells // pieces)

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(pieces * width, np.int64)
        seen = False
        for batch in batches:
            if batch.num_rows:
                seen = True
                count(batch, total[:cells])
        if seen:
            small = total.max() < 2**31 and total.min() >= -(2**31)
            packed = total.astype(np.int32) if small else total
            yield pa.RecordBatch.from_pydict(
                {
                    "piece": pa.array(np.arange(pieces, dtype=np.int32)),
                    "counts": pa.array([part.tobytes() for part in np.split(packed, pieces)]),
                }
            )

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, counts in zip(batch["piece"].to_pylist(), batch["counts"]):
                raw = counts.as_buffer()
                kind = np.int32 if raw.size == 4 * width else np.int64
                if piece not in sums:
                    sums[piece] = np.zeros(width, np.int64)
                sums[piece] += np.frombuffer(raw, kind)
        yield pa.RecordBatch.from_pydict(
            {
                "piece": pa.array(list(sums), pa.int32()),
                "counts": pa.array([part.tobytes() for part in sums.values()], pa.binary()),
            }
        )

    kind = "piece int, counts binary"
    parts = df.mapInArrow(own, kind).repartition(8, "piece").mapInArrow(together, kind)
    total = np.zeros(pieces * width, np.int64)
    for piece, counts in parts.collect():
        total[piece * width : (piece + 1) * width] = np.frombuffer(counts, np.int64)
    return total[:cells]


def bitmap(df: DataFrame, value: Column, bits: int) -> np.ndarray:
    """A bitmap of 2**bits bits with the top bits of each 64-bit value set.

    The driver receives at most 2**(bits - 6) words, whatever the number of rows.
    """
    slot = F.shiftrightunsigned(value, 64 - bits)
    words = (
        df.select(slot.alias("slot"))
        .groupBy(F.shiftright("slot", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot & 63 as int))")).alias("ones"))
    )
    out = np.zeros(1 << (bits - 6), np.uint64)
    found = words.toArrow()
    at = found["word"].to_numpy()
    out[at] = found["ones"].to_numpy().view(np.uint64)
    return out


def in_bitmap(words: np.ndarray, bits: int, hashes: np.ndarray) -> np.ndarray:
    slot = hashes >> np.uint64(64 - bits)
    return (words[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1
