"""Importance resampling of raw text towards a target, with hashed n-gram models."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import least_hashed, summed_counts, whole_text
from orderloom.llm.mixing import unit
from orderloom.llm.textscan import NOT_ALNUM, SPACE, WordHasher, ngrams
from orderloom.operators.ordering import with_row_number
from orderloom.scratch import stage

BUCKET_BITS = 14
TARGET_DOCS = 20_000  # labelled rows of which the target model is made, at most
SMOOTHING = 1.0


def feature_reader() -> Callable[[pa.Array], Iterator[tuple[int, int, np.ndarray, np.ndarray]]]:
    """Features of a text column: (first row, row after the last, buckets, rows).

    The features are words, pairs of neighbouring words, and runs of other visible signs,
    all with their case, each hashed to one of 2**BUCKET_BITS buckets.
    """
    signs = ~NOT_ALNUM | SPACE
    words, marks = WordHasher(NOT_ALNUM), WordHasher(signs, seed=11)
    shift = np.uint64(64 - BUCKET_BITS)

    def read(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        for (lo, hi, hashes, rows), (_, _, other, other_rows) in zip(
            words.blocks(column), marks.blocks(column)
        ):
            pairs, at = ngrams(hashes, rows, (0, 1))
            found = np.concatenate([hashes, pairs, other]) >> shift
            yield lo, hi, found.astype(np.int64), np.concatenate([rows, rows[at], other_rows])

    return read


def _target_sample(labels: DataFrame, key: str, label: str) -> DataFrame:
    chosen = labels.where(F.col(label) == 1).select(F.col(key).alias("_target")).distinct()
    return least_hashed(chosen, F.xxhash64("_target"), TARGET_DOCS, chosen.count())


def log_ratios(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str) -> np.ndarray:
    """log P_target(bucket) - log P_raw(bucket), from one pass over all documents.

    The raw model counts every document.  The target model counts the documents of at most
    TARGET_DOCS target labels, those with the least hash; that bound is why their ids can
    be broadcast.
    """
    cells = 1 << BUCKET_BITS
    readers: list = []  # one per task

    def count(batch: pa.RecordBatch, total: np.ndarray) -> None:
        if not readers:
            readers.append(feature_reader())
        target = batch["target"].to_numpy(zero_copy_only=False)
        for lo, hi, buckets, rows in readers[0](batch["text"]):
            total[:cells] += np.bincount(buckets, minlength=cells)
            chosen = buckets[target[lo:hi][rows]]
            total[cells:] += np.bincount(chosen, minlength=cells)

    sample = _target_sample(labels, key, label)
    own = docs.select(F.col(key).alias("_key"), whole_text(text).alias("text"))
    marked = own.join(F.broadcast(sample), F.col("_key") == F.col("_target"), "left")
    counts = summed_counts(
        marked.select("text", F.col("_target").isNotNull().alias("target")), count, 2 * cells
    ).astype(np.float64)
    raw, target = counts[:cells] + SMOOTHING, counts[cells:] + SMOOTHING
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def log_weights(docs: DataFrame, ratios: np.ndarray, text: str = "text") -> DataFrame:
    """Add ``log_weight``, the sum of the log ratios of a document's features."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = feature_reader()
        for batch in batches:
            for lo, hi, buckets, rows in reader(batch["text"]):
                found = np.bincount(rows, weights=ratios[buckets], minlength=hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(lo, hi - lo), pa.array(found)],
                    names=["doc_id", "log_weight"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    own = docs.select("doc_id", whole_text(text).alias("text"))
    return own.mapInArrow(scan, f"doc_id {kind}, log_weight double")


def resample(
    docs: DataFrame,
    labels: DataFrame,
    k: int | None = None,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    seed: int = 29,
) -> DataFrame:
    """doc_id, log_weight, gumbel_key and kept of each document.

    Documents are sampled without replacement with probability in proportion to their
    weight: a Gumbel number drawn by seed and doc_id is added to the log weight, and the k
    documents with the greatest sums are kept.  Without ``k`` it is the share of target
    labels among all labels (all documents if there are none), of all documents.

    A document without features has log weight 0.  Without target labels the target model
    is flat.  Null texts are empty; a null id draws a number of its own value.  Equal sums
    go by doc_id, then by place.  Repeated rows have equal sums and count one by one.
    Empty tables give no rows; other columns are not read.
    """
    own = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    ratios = log_ratios(docs, labels, key, text, label)
    u = unit(F.lit(f"gumbel{seed}"), F.col("doc_id"))
    weighted = log_weights(own, ratios).withColumn(
        "gumbel_key", F.col("log_weight") - F.log(-F.log(u))
    )
    scored = stage(weighted.withColumn("_row", F.monotonically_increasing_id()), "log-weights")
    if k is None:
        known = labels.agg(F.count(label), F.sum(F.when(F.col(label) == 1, 1))).first()
        share = (known[1] or 0) / known[0] if known[0] else 1.0
        k = round(scored.count() * share)
    ranked = with_row_number(scored, [F.col("gumbel_key").desc(), "doc_id", "_row"], "_rank")
    return ranked.select("doc_id", "log_weight", "gumbel_key", (F.col("_rank") <= k).alias("kept"))
