"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import least_hashed, whole_text
from orderloom.llm.textscan import NOT_ALNUM, WordHasher, ngrams

SAMPLE_ROWS = 16_000  # labelled rows the model is fitted on, at most
SAMPLE_BYTES = 65_536  # a sampled text is no longer
BUCKET_BITS = 20
GRAMS = ((0,), (0, 1), (0, 2))  # words, neighbours, and words with one between


@dataclass(frozen=True)
class Ftrl:
    """Per-coordinate rates alpha / (beta + sqrt(sum of squared gradients)), L1 and L2.

    A toxic example counts ``toxic_weight`` times, as they are the fewer.
    """

    alpha: float = 3.0
    beta: float = 1.0
    l1: float = 20.0
    l2: float = 0.0
    epochs: int = 4
    toxic_weight: float = 4.0


@dataclass(frozen=True)
class SparseWeights:
    """The weights that L1 left: buckets in ascending order, and a bias."""

    buckets: np.ndarray
    values: np.ndarray
    bias: float

    def dense(self) -> np.ndarray:
        out = np.zeros(1 << BUCKET_BITS, np.float64)
        out[self.buckets] = self.values
        return out


def feature_reader() -> Callable[[pa.Array], Iterator[tuple[int, int, np.ndarray, np.ndarray]]]:
    """(first row, row after the last, bucket, row) of each gram of a lower-case column."""
    hasher, shift = WordHasher(NOT_ALNUM), np.uint64(64 - BUCKET_BITS)

    def read(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        for lo, hi, hashes, rows in hasher.blocks(column):
            buckets, owners = [], []
            for offsets in GRAMS:
                grams, at = ngrams(hashes, rows, offsets)
                buckets.append((grams >> shift).astype(np.int64))
                owners.append(rows[at])
            yield lo, hi, np.concatenate(buckets), np.concatenate(owners)

    return read


def fit(examples: list[tuple[np.ndarray, int]], ftrl: Ftrl) -> SparseWeights:
    """One pass after another over (distinct buckets, label); the bias has no penalty."""
    size = 1 << BUCKET_BITS
    z, n = np.zeros(size), np.zeros(size)
    bias, bias_n = 0.0, 0.0

    def weights(at: np.ndarray) -> np.ndarray:
        zs = z[at]
        scale = (ftrl.beta + np.sqrt(n[at])) / ftrl.alpha + ftrl.l2
        return np.where(np.abs(zs) > ftrl.l1, (np.sign(zs) * ftrl.l1 - zs) / scale, 0.0)

    for _ in range(ftrl.epochs):
        for at, label in examples:
            w = weights(at)
            p = 1 / (1 + np.exp(-np.clip(w.sum() + bias, -35, 35)))
            g = (p - label) * (ftrl.toxic_weight if label else 1.0)
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ftrl.alpha
            z[at] += g - sigma * w
            n[at] += g * g
            bias_n += g * g
            bias -= ftrl.alpha * g / (ftrl.beta + np.sqrt(bias_n))
    used = np.flatnonzero(np.abs(z) > ftrl.l1)
    return SparseWeights(used, weights(used), float(bias))


def train(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    ftrl: Ftrl = Ftrl(),
) -> SparseWeights:
    """Fit on at most SAMPLE_ROWS labelled documents, those whose ids hash lowest.

    FTRL takes one example after another, so a single task fits the bounded sample; only
    the sparse weights come back.  An id with several labels is toxic if one says so; null
    labels and ids, and texts of more than SAMPLE_BYTES, are not sampled.  Without labelled
    documents all weights are 0, which scores 0.5.
    """
    known = (
        labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(key).alias("_id"))
        .agg(F.max(label).cast("int").alias("label"))
    )
    hashed = F.xxhash64("_id")
    # a generous number of ids, as some have no document or a long one
    ids = least_hashed(known, hashed, 2 * SAMPLE_ROWS, known.count())
    own = docs.select(F.col(key).alias("_key"), F.lower(whole_text(text)).alias("text"))
    short = own.where(F.octet_length("text") <= SAMPLE_BYTES)
    sample = (
        short.join(F.broadcast(ids), F.col("_key") == F.col("_id"))
        .orderBy(hashed, "_id", F.xxhash64("text"))
        .limit(SAMPLE_ROWS)
        .select("label", "text")
    )

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, examples = feature_reader(), []
        for batch in batches:
            marks = batch["label"].to_numpy()
            for lo, hi, buckets, rows in reader(batch["text"]):
                keys = np.unique((rows << BUCKET_BITS) | buckets)
                bounds = np.searchsorted(keys >> BUCKET_BITS, np.arange(1, hi - lo))
                parts = np.split((keys & ((1 << BUCKET_BITS) - 1)).astype(np.int32), bounds)
                examples += zip(parts, marks[lo:hi].tolist())
        model = fit(examples, ftrl)
        yield pa.RecordBatch.from_pydict(
            {
                "buckets": pa.array([model.buckets.astype(np.int64).tobytes()]),
                "weights": pa.array([model.values.tobytes()]),
                "bias": pa.array([model.bias]),
            }
        )

    rows = sample.coalesce(1).mapInArrow(learn, "buckets binary, weights binary, bias double")
    found = max(rows.collect(), key=lambda r: len(r["buckets"]), default=None)
    if found is None:
        return SparseWeights(np.empty(0, np.int64), np.empty(0), 0.0)
    return SparseWeights(
        np.frombuffer(found["buckets"], np.int64), np.frombuffer(found["weights"]), found["bias"]
    )


def score(
    docs: DataFrame, model: SparseWeights, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id and score (0 to 1) of each document, from its whole text alone.

    Null texts are empty, and an empty text has the score of the bias.  Repeated rows are
    scored one by one; other columns are not read; empty tables give no rows.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, dense = feature_reader(), model.dense()
        heavy = dense != 0
        for batch in batches:
            for lo, hi, buckets, rows in reader(batch["text"]):
                some = heavy[buckets]
                keys = np.unique((rows[some] << BUCKET_BITS) | buckets[some])
                sums = np.bincount(
                    keys >> BUCKET_BITS,
                    weights=dense[keys & ((1 << BUCKET_BITS) - 1)],
                    minlength=hi - lo,
                )
                p = 1 / (1 + np.exp(-np.clip(sums + model.bias, -35, 35)))
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(lo, hi - lo), pa.array(p)], names=["doc_id", "score"]
                )

    own = docs.select(F.col(key).alias("doc_id"), F.lower(whole_text(text)).alias("text"))
    kind = own.schema["doc_id"].dataType.simpleString()
    return own.mapInArrow(scan, f"doc_id {kind}, score double")


def is_held_out(key: str = "doc_id"):
    """Rows whose label is never learned from; a null id is not held out."""
    remainder = F.crc32(F.encode(F.col(key).cast("string"), "UTF-8")) % 3
    return F.coalesce(remainder == 1, F.lit(False))


def toxic_documents(
    docs: DataFrame, labels: DataFrame, limit: float = 0.7, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """doc_id, held_out, score and predicted, by a model of the labels not held out."""
    model = train(docs, labels.where(~is_held_out(key)), key, text)
    return score(docs, model, key, text).select(
        "doc_id",
        is_held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= limit).cast("int").alias("predicted"),
    )
