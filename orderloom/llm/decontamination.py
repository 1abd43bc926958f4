"""Documents that hold benchmark passages, found by spaced seeds and verified.

A seed is a fixed mask over consecutive words: the words under its ones are hashed, those
under its zeros are ignored, so a word that was replaced under a zero does not hide a
passage.  Seeds of the benchmark and of the documents are joined on their hashes, and
around each hit the two texts are compared word by word along the hit's diagonal.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import bitmap, in_bitmap, whole_text
from orderloom.llm.textscan import NOT_ALNUM, WordHasher, mix, ngrams, signed
from orderloom.scratch import stage

FILTER_BITS = 25


@dataclass(frozen=True)
class Overlap:
    """What counts as a seed and as an overlap.

    An overlap is a stretch on one diagonal in which at least ``percent`` of the words
    agree, with ``min_words`` agreeing words or, for shorter items, all but one in five of
    the item's.  Items of fewer than ``least_item`` words are not looked for.

    Items of ``full_item`` words or more use ``masks``, shorter ones ``light``.  With the
    values below no overlap is without a seed, whatever words are replaced; a test goes
    through all patterns.  Other values may ask for other masks.
    """

    masks: tuple[str, ...] = (
        "1111011", "110010111", "11011101", "10101111", "111110001", "111101001",
    )
    light: tuple[str, ...] = ("1111", "11011", "10111", "11101")
    full_item: int = 11
    min_words: int = 13
    least_item: int = 5
    percent: int = 75

    def offsets(self) -> list[tuple[int, ...]]:
        return _ones(self.masks)

    def item_offsets(self, n: int) -> list[tuple[int, ...]]:
        """Of the masks that an item of n words uses."""
        return self.offsets() if n >= self.full_item else _ones(self.light)

    def span(self) -> int:
        return max(map(len, self.masks))


def _ones(masks: tuple[str, ...]) -> list[tuple[int, ...]]:
    return [tuple(i for i, c in enumerate(m) if c == "1") for m in masks]


def _second(hashes: np.ndarray) -> np.ndarray:
    return mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5))


def benchmark_words(items: DataFrame, key: str, text: str) -> DataFrame:
    """Items with their words as 64-bit hashes (binary), null texts without words."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(NOT_ALNUM)
        for batch in batches:
            for lo, hi, hashes, rows in hasher.blocks(batch["text"]):
                parts = np.split(hashes, np.searchsorted(rows, np.arange(1, hi - lo)))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["item_id"].slice(lo, hi - lo),
                        pa.array([p.tobytes() for p in parts], pa.binary()),
                    ],
                    names=["item_id", "item_words"],
                )

    own = items.select(F.col(key).alias("item_id"), F.lower(whole_text(text)).alias("text"))
    kind = own.schema["item_id"].dataType.simpleString()
    return own.mapInArrow(scan, f"item_id {kind}, item_words binary")


def benchmark_seeds(words: DataFrame, overlap: Overlap) -> DataFrame:
    """Rows (h, item_id, q): each seed of each item and where it starts."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                own = np.frombuffer(batch["item_words"][row].as_buffer(), np.uint64)
                if len(own) < overlap.least_item:
                    continue
                zeros = np.zeros(len(own), np.int64)
                found = [ngrams(own, zeros, used) for used in overlap.item_offsets(len(own))]
                h = np.concatenate([f[0] for f in found])
                q = np.concatenate([f[1] for f in found])
                one = batch["item_id"].slice(row, 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(signed(h)),
                        one.take(pa.array(np.zeros(len(h), np.int64))),
                        pa.array(q),
                    ],
                    names=["h", "item_id", "q"],
                )

    kind = words.schema["item_id"].dataType.simpleString()
    return words.mapInArrow(scan, f"h long, item_id {kind}, q long").distinct()


def document_hits(
    docs: DataFrame, seeds_filter: np.ndarray, offsets: list[tuple[int, ...]]
) -> DataFrame:
    """Documents with a seed that the filter lets through: words and hits."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(NOT_ALNUM)
        for batch in batches:
            for lo, hi, hashes, rows in hasher.blocks(batch["lowered"]):
                hits, places = [], []
                for mask in offsets:
                    h, at = ngrams(hashes, rows, mask)
                    some = np.flatnonzero(in_bitmap(seeds_filter, FILTER_BITS, h))
                    some = some[in_bitmap(seeds_filter, FILTER_BITS, _second(h[some]))]
                    hits.append(h[some])
                    places.append(at[some])
                h, at = np.concatenate(hits), np.concatenate(places)
                if not len(h):
                    continue
                order = np.argsort(rows[at], kind="stable")
                h, at = h[order], at[order]
                owner = rows[at]
                held, first = np.unique(owner, return_index=True)
                bounds = np.append(first, len(h))
                starts = np.searchsorted(rows, np.arange(hi - lo + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(lo, hi - lo).take(pa.array(held)),
                        batch["digest"].slice(lo, hi - lo).take(pa.array(held)),
                        pa.array(
                            [hashes[starts[r] : starts[r + 1]].tobytes() for r in held],
                            pa.binary(),
                        ),
                        pa.ListArray.from_arrays(
                            pa.array(bounds.astype(np.int32)), pa.array(signed(h))
                        ),
                        pa.ListArray.from_arrays(
                            pa.array(bounds.astype(np.int32)), pa.array(at - starts[owner])
                        ),
                    ],
                    names=["doc_id", "digest", "doc_words", "h", "p"],
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(
        scan, f"doc_id {kind}, digest string, doc_words binary, h array<long>, p array<long>"
    )


def best_stretch(same: np.ndarray, percent: int) -> tuple[int, int]:
    """Start and end of the stretch that scores most, if a word that agrees scores
    100 - percent and another one -percent; so that at least percent agree."""
    if not len(same):
        return 0, 0
    score = np.concatenate([[0], np.cumsum(np.where(same, 100 - percent, -percent))])
    lowest = np.minimum.accumulate(score)
    end = int(np.argmax(score - lowest))
    start = int(np.argmin(score[: end + 1]))
    return start, end


def widest_stretch(same: np.ndarray, percent: int) -> tuple[int, int]:
    """Start and end of the stretch with most agreeing words among all in which at least
    percent agree, without the others at its ends; the first if there are several.

    The longest such stretch has most: unless it is the whole, one more word would take it
    below percent, so its length fixes how many agree; and others extend to such a one.
    """
    if not len(same):
        return 0, 0
    score = np.concatenate([[0], np.cumsum(np.where(same, 100 - percent, -percent))])
    # the first start from which the score does not sink, for each end
    starts = np.searchsorted(-np.minimum.accumulate(score), -score)
    end = int(np.argmax(np.arange(len(score)) - starts))
    start = int(starts[end])
    inside = np.flatnonzero(same[start:end])
    return (start + int(inside[0]), start + int(inside[-1]) + 1) if len(inside) else (0, 0)


def overlap_stretch(same: np.ndarray, least: int, percent: int) -> tuple[int, int] | None:
    """The stretch that scores most if it has ``least`` agreeing words, else the one with
    most agreeing words, else none: then no stretch is an overlap."""
    for find in (best_stretch, widest_stretch):
        start, end = find(same, percent)
        if same[start:end].sum() >= least:
            return start, end
    return None


def _verified(pairs: DataFrame, overlap: Overlap) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, out = [], []
            for row in range(batch.num_rows):
                # the words of the document that lie beside the item's, from its word lo on
                beside = np.frombuffer(batch["beside"][row].as_buffer(), np.uint64)
                item = np.frombuffer(batch["item_words"][row].as_buffer(), np.uint64)
                diagonal = batch["diagonal"][row].as_py()
                lo = max(0, -diagonal)
                same = beside == item[lo : lo + len(beside)]
                least = min(overlap.min_words, -(-4 * len(item) // 5))
                found = overlap_stretch(same, least, overlap.percent)
                if found:
                    start, end = found
                    agree = int(same[start:end].sum())
                    keep.append(row)
                    out.append((lo + diagonal + start, lo + start, end - start, agree))
            if keep:
                kept = batch.take(pa.array(keep))
                yield pa.RecordBatch.from_arrays(
                    [kept["_row"], kept["doc_id"], kept["digest"], kept["item_id"]]
                    + [pa.array([o[i] for o in out], pa.int64()) for i in range(4)],
                    names=["_row", "doc_id", "digest", "item_id", "doc_start", "item_start",
                           "n_words", "n_same"],
                )

    kinds = {f.name: f.dataType.simpleString() for f in pairs.schema.fields}
    return pairs.mapInArrow(
        scan,
        f"_row long, doc_id {kinds['doc_id']}, digest string, item_id {kinds['item_id']}, "
        "doc_start long, item_start long, n_words long, n_same long",
    )


def overlaps(
    docs: DataFrame,
    items: DataFrame,
    overlap: Overlap = Overlap(),
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row per document and benchmark item that share a passage.

    Columns: _row and digest of the document, doc_id, item_id, and the verified stretch
    with most agreeing words, of one per diagonal (``overlap_stretch``): its first word in
    document and item, its words, and how many agree.  Words
    are runs of ASCII letters and digits and of other code points beyond ASCII, in lower
    case, so punctuation and layout do not matter.  Null and empty texts share nothing.
    Rows that repeat an id are told apart; null ids stay null.  Empty tables on either
    side give no rows; other columns are not read.

    The documents are read once.  A Bloom filter of fixed size over the benchmark's seeds
    lets few seeds out of the scan, with the words of the documents they are in; the rest
    is joined.  A seed in a third of all documents is split by the skew join.
    """
    words = stage(benchmark_words(items, item_key, item_text), "benchmark-words")
    length = (F.octet_length("item_words") / 8).cast("int")
    full = (length >= overlap.full_item).alias("full")
    kinds = words.where(length >= overlap.least_item).select(full).distinct().collect()
    lengths = {overlap.full_item if r.full else overlap.least_item for r in kinds}
    offsets = [used for n in lengths or {overlap.full_item} for used in overlap.item_offsets(n)]
    seeds = stage(benchmark_seeds(words, overlap), "benchmark-seeds")
    mask = _filter(seeds)
    own = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).select(
        "doc_id", F.md5("text").alias("digest"), F.lower(whole_text("text")).alias("lowered")
    )
    hits = document_hits(own, mask, offsets)
    hits = stage(hits.withColumn("_row", F.monotonically_increasing_id()), "seed-hits")
    each = hits.select("_row", F.explode(F.arrays_zip("h", "p")).alias("hit"))
    met = each.select("_row", F.col("hit.h").alias("h"), F.col("hit.p").alias("p")).join(seeds, "h")
    diagonals = met.select("_row", "item_id", (F.col("p") - F.col("q")).alias("diagonal")).distinct()
    pairs = diagonals.join(words, "item_id").join(hits.drop("h", "p"), "_row")
    # a document that repeats a phrase has many diagonals: each takes only the words beside
    # the item along, so the work grows with the text and not with its square
    from_word = F.greatest(F.lit(0), -F.col("diagonal"))
    first = (from_word + F.col("diagonal")) * 8
    n_bytes = F.octet_length("item_words") - from_word * 8
    beside = F.substr("doc_words", (first + 1).cast("int"), n_bytes.cast("int"))
    found = _verified(
        pairs.select(
            "_row", "doc_id", "digest", "item_id", "diagonal", beside.alias("beside"), "item_words"
        ),
        overlap,
    )
    place = F.struct("n_same", -F.col("doc_start"), "item_start", "n_words", "doc_start")
    return (
        found.groupBy("_row", "doc_id", "digest", "item_id")
        .agg(F.max(place).alias("best"))
        .select(
            "_row", "doc_id", "digest", "item_id", "best.doc_start", "best.item_start",
            "best.n_words", "best.n_same",
        )
    )


def _filter(seeds: DataFrame) -> np.ndarray:
    """Bits of both hashes of each seed, of fixed size."""

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch["h"].to_numpy().view(np.uint64)
            yield pa.RecordBatch.from_pydict(
                {"h": pa.array(signed(np.concatenate([h, _second(h)])))}
            )

    return bitmap(seeds.select("h").mapInArrow(both, "h long"), F.col("h"), FILTER_BITS)


def contaminated_documents(docs: DataFrame, items: DataFrame, **names) -> DataFrame:
    """doc_id, item_id and the longest stretch of each verified overlap."""
    return overlaps(docs, items, **names).drop("_row", "digest")


def clean_documents(
    docs: DataFrame, items: DataFrame, overlap: Overlap = Overlap(), text: str = "text", **names
) -> DataFrame:
    """The documents without a verified overlap, with their own columns.

    The verdict follows from the text alone, so documents go by the digest of their text.
    """
    found = overlaps(docs, items, overlap, text=text, **names)
    bad = stage(found.select(F.col("digest").alias("_digest")).distinct(), "contaminated")
    return docs.join(bad, F.md5(docs[text]) == bad["_digest"], "left_anti")
