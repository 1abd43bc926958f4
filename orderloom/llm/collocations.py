"""Phrases whose words stand together more often than their parts would.

Word positions are suffix pointers: the words from there to the end of the piece, five at
most.  Suffixes go to buckets by their leading words, and in a bucket a multikey three-way
quicksort parts the pointers by one word at a time.  The pointers equal to the pivot share
a phrase, so the size of that part is the phrase's count, and a part with fewer pointers
than a phrase must have is abandoned.  The quicksort works on all open parts at once, in
numpy, so its loop runs as often as the deepest part is parted, not once per part.

How many leading words decide the bucket follows from a fixed-size sketch of how often
each beginning occurs: two, or more where a beginning holds too large a share.  Counts of
phrases shorter than that are partial in a bucket and are summed over buckets.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import bitmap, in_bitmap, small_batches, whole_text
from orderloom.llm.textscan import BLOCK, LOWER, WordHasher, mix, signed, text_buffers
from orderloom.scratch import stage

DEPTH = 5
SKETCH = 1 << 16  # cells for beginnings of suffixes
WORD_BITS = 25  # bitmap of frequent words, 4 MB
COMMON = 1 << 15  # most frequent words, which have numbers of their own
CHUNK = 1 << 20  # suffixes that a task sorts at a time
BUCKET = 1 << 20  # words of the corpus per bucket, about
WIDE = 1 << 10  # a beginning with more than 1/WIDE of all words goes by one more word

# ASCII only, so bytes of longer code points are never separators
GAP = np.zeros(256, bool)
GAP[[0x20, 0x09]] = True
BREAK = np.zeros(256, bool)
BREAK[[ord(c) for c in ".,;:!?"] + [0x0A, 0x0B, 0x0C, 0x0D]] = True

_MULTIPLIER = 0x9E3779B97F4A7C15


class Words(NamedTuple):
    hashes: np.ndarray  # never 0
    piece: np.ndarray  # equal for words of the same piece, rising
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray


class PieceHasher(WordHasher):
    """Words of a block of texts with the piece each belongs to; the language is hashed in."""

    def __init__(self) -> None:
        super().__init__(BREAK | GAP, seed=13)

    def words(self, data: np.ndarray, offs: np.ndarray, salts: np.ndarray) -> Words:
        n = len(data)
        empty = np.empty(0, np.int64)
        if n == 0:
            return Words(np.empty(0, np.uint64), empty, empty, empty, empty)
        inside = ~self.separators[data]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        cuts = offs[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < n)]
        first[cuts] = inside[cuts]
        last[cuts - 1] = inside[cuts - 1]
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        row = np.searchsorted(offs, start, side="right") - 1
        self._powers(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.values[data] * self.up[:n], out=sums[1:])
        raw = (sums[end] - sums[start]) * self.down[start] + (end - start).astype(np.uint64)
        hashes = mix(raw ^ salts[row])
        hashes[hashes == 0] = 1
        piece = np.cumsum(BREAK[data])[start] + row
        return Words(hashes, piece, row, start, end)


def _blocks(column: pa.Array, size: int = 2 * BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(lower-cased bytes, row offsets, first row) of whole rows, ``size`` bytes or one row."""
    data, offs = text_buffers(column)
    at, rows = 0, len(offs) - 1
    while at < rows:
        to = int(np.searchsorted(offs, offs[at] + size, side="right")) - 1
        to = min(max(to, at + 1), rows)
        yield LOWER[data[offs[at] : offs[to]]], offs[at : to + 1] - offs[at], at
        at = to


def _parts(data: np.ndarray, offs: np.ndarray, size: int = 4 * BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A block as it is, or one long text in parts that end where a piece ends."""
    at, n = 0, len(data)
    if n <= size or len(offs) > 2:
        yield data, offs
        return
    while at < n:
        cut = min(at + size, n)
        if cut < n:
            found = np.flatnonzero(BREAK[data[at:cut]])
            beyond = np.flatnonzero(BREAK[data[cut:]]) if not len(found) else found
            if len(found):
                cut = at + int(found[-1]) + 1
            else:
                cut = cut + int(beyond[0]) + 1 if len(beyond) else n
        yield data[at:cut], np.array([0, cut - at])
        at = cut


def _salts(langs: list[str]) -> np.ndarray:
    known: dict[str, int] = {}
    for lang in langs:
        if lang not in known:
            total = 0
            for byte in lang.encode():
                total = (total * 0x100000001B3 + byte + 1) % 2**64
            known[lang] = total
    return mix(np.array([known[lang] for lang in langs], np.uint64))


def _prefix_hashes(matrix: np.ndarray) -> np.ndarray:
    """Hash of the first 2, 3, 4 and 5 words of each suffix, as columns."""
    state = mix(matrix[:, 0])
    out = np.empty((len(matrix), DEPTH - 1), np.uint64)
    for k in range(1, DEPTH):
        state = mix(state * np.uint64(_MULTIPLIER) + matrix[:, k])
        out[:, k - 1] = state
    return out


def suffixes(words: Words, kept: np.ndarray) -> np.ndarray:
    """A row of up to five hashes (0 behind the end) from each kept word with a kept next one.

    A suffix ends with its piece, and before a word that is not kept.
    """
    n = len(words.hashes)
    padded = np.zeros(n + DEPTH, np.uint64)
    padded[:n] = np.where(kept, words.hashes, 0)
    piece = np.full(n + DEPTH, -1, np.int64)
    piece[:n] = words.piece
    matrix = np.zeros((n, DEPTH), np.uint64)
    going = kept.copy()
    for k in range(DEPTH):
        going &= (padded[k : k + n] != 0) & (piece[k : k + n] == words.piece)
        matrix[going, k] = padded[k : k + n][going]
    return matrix[matrix[:, 1] != 0]


# ---------------------------------------------------------------- quicksort


def multikey_quicksort(
    suffix: np.ndarray, weight: np.ndarray, least: int, whole_from: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Count phrases: yields (length, pointer to an example, count) for lengths 2 and more.

    ``suffix`` has a row of word codes per distinct suffix, 0 behind its end; ``weight`` is
    how often it occurs.  Parts that can only hold phrases of ``whole_from`` words or more
    are abandoned once they hold fewer than ``least`` occurrences; shorter phrases are
    counted whatever their size.

    All open parts are parted at once: each takes the word of its middle pointer as pivot,
    and pointers move behind each other as less, equal and greater.  Those equal go on with
    the next word.
    """
    pointers = np.arange(len(suffix))
    starts = np.zeros(1 if len(suffix) else 0, np.int64)
    sizes = np.full(len(starts), len(suffix), np.int64)
    depths = np.zeros(len(starts), np.int64)
    while len(starts):
        part = np.repeat(np.arange(len(starts)), sizes)
        word = suffix[pointers, depths[part]]
        pivot = word[starts + sizes // 2]
        side = (word >= pivot[part]).astype(np.int8) + (word > pivot[part])
        slot = 3 * part + side
        counts = np.bincount(slot, minlength=3 * len(starts))
        begins = np.cumsum(counts) - counts
        place = np.empty(len(pointers), np.int64)
        for which in range(3):
            here = side == which
            running = np.cumsum(here)
            before = running[starts] - here[starts]
            place[here] = (begins[3 * part + which] + running - 1 - before[part])[here]
        moved = np.empty_like(pointers)
        moved[place] = pointers
        totals = np.bincount(slot, weight[pointers], minlength=3 * len(starts))

        length = np.repeat(depths + 1, 3)
        middle = np.tile(np.array([False, True, False]), len(starts))
        value = np.repeat(pivot, 3)
        # a part's phrases have at least ``length`` words
        open_ = (counts > 0) & ((totals >= least) | (np.maximum(length, 2) < whole_from))
        phrase = open_ & middle & (value != 0) & (length >= 2)
        for k in np.unique(length[phrase]):
            found = phrase & (length == k)
            yield int(k), moved[begins[found]], totals[found].astype(np.int64)
        # an equal part goes deeper unless its suffixes have ended; 0 is never another's pivot
        deeper = middle & (value != 0) & (length < suffix.shape[1])
        alone = ~middle
        open_ &= deeper | alone
        kept = np.repeat(open_, counts)
        pointers = moved[kept]
        sizes = counts[open_]
        depths = np.where(middle, length, length - 1)[open_]
        starts = np.cumsum(sizes) - sizes


# ---------------------------------------------------------------- tasks


def _word_table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per chunk: each distinct word with its count, and the sketch of beginnings."""
    hasher = PieceHasher()
    sketch = np.zeros(SKETCH, np.int64)
    for batch in batches:
        langs = batch["lang"].to_pylist()
        salts = _salts(langs) if langs else np.empty(0, np.uint64)
        for block, offs, at in _blocks(batch["text"]):
            for data, bounds in _parts(block, offs):
                found = hasher.words(data, bounds, salts[at : at + len(bounds) - 1])
                if not len(found.hashes):
                    continue
                every = np.ones(len(found.hashes), bool)
                cells = _prefix_hashes(suffixes(found, every)) >> np.uint64(48)
                sketch += np.bincount(cells[:, :3].ravel().astype(np.int64), minlength=SKETCH)
                own, example, count = np.unique(
                    found.hashes, return_index=True, return_counts=True
                )
                raw = data.tobytes()
                texts = [
                    raw[a:b].decode("utf-8", "replace")
                    for a, b in zip(found.start[example].tolist(), found.end[example].tolist())
                ]
                yield pa.RecordBatch.from_pydict(
                    {
                        "hash": pa.array(signed(own)),
                        "lang": pa.array([langs[at + r] for r in found.row[example].tolist()]),
                        "word": pa.array(texts),
                        "n": pa.array(count.astype(np.int64)),
                    }
                )
    filled = np.flatnonzero(sketch)
    if len(filled):
        yield pa.RecordBatch.from_pydict(
            {
                "hash": pa.array(filled),
                "lang": pa.nulls(len(filled), pa.string()),
                "word": pa.nulls(len(filled), pa.string()),
                "n": pa.array(sketch[filled]),
            }
        )


def _collapsed(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct suffixes in order, with their counts."""
    order = np.lexsort(matrix.T[::-1])
    matrix = matrix[order]
    fresh = np.ones(len(matrix), bool)
    fresh[1:] = (matrix[1:] != matrix[:-1]).any(axis=1)
    starts = np.flatnonzero(fresh)
    return matrix[starts], np.diff(np.append(starts, len(matrix)))


class Codes:
    """Small numbers for the most frequent words, by falling count; 0 is the end of a suffix."""

    def __init__(self, by_count: np.ndarray):
        order = np.argsort(by_count)
        self.by_count, self.ordered, self.number = by_count, by_count[order], order + 1

    def of(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(numbers, 0 where there is none; where there is one or the suffix has ended)."""
        if not len(self.ordered):
            return np.zeros(hashes.shape, np.int64), hashes == 0
        at = np.minimum(np.searchsorted(self.ordered, hashes), len(self.ordered) - 1)
        found = self.ordered[at] == hashes
        return np.where(found, self.number[at], 0), found | (hashes == 0)


def pack(
    matrix: np.ndarray, codes: np.ndarray, known: np.ndarray, weight: np.ndarray, routed: np.ndarray
) -> bytes:
    """Suffixes as numbers, column by column and byte by byte, compressed.

    Words without a number of their own (not ``known``) get numbers above ``COMMON`` by a
    dictionary that goes along.
    """
    rest, places = np.unique(matrix[~known], return_inverse=True)
    codes = codes.copy()
    codes[~known] = COMMON + 1 + places
    width = 2 if COMMON + 1 + len(rest) < 1 << 16 else 4
    planes = [(codes.T >> 8 * b).astype(np.uint8).tobytes() for b in range(width)]
    head = np.array([len(rest), len(matrix), width], np.int64).tobytes()
    body = [head, rest.tobytes(), weight.astype(np.int64).tobytes(), routed.astype(np.int8).tobytes()]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(body + planes))


def unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(numbers, dictionary of those above ``COMMON``, weights, routes)."""
    raw = zstandard.ZstdDecompressor().decompress(blob)
    words, rows, width = np.frombuffer(raw, np.int64, 3).tolist()
    rest = np.frombuffer(raw, np.uint64, words, 24)
    at = 24 + 8 * words
    weight = np.frombuffer(raw, np.int64, rows, at)
    routed = np.frombuffer(raw, np.int8, rows, at + 8 * rows)
    planes = np.frombuffer(raw, np.uint8, width * DEPTH * rows, at + 9 * rows)
    codes = np.zeros((DEPTH, rows), np.int64)
    for b, plane in enumerate(planes.reshape(width, DEPTH, rows)):
        codes |= plane.astype(np.int64) << 8 * b
    return codes.T, rest, weight, routed


def _router(sent: Broadcast, buckets: int):
    """Cut texts into suffixes of frequent words and send them to buckets."""

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = PieceHasher()
        words, crowded, common = sent.value
        numbers = Codes(common)
        held: list[np.ndarray] = []

        def packed() -> pa.RecordBatch:
            matrix, weight = _collapsed(np.concatenate(held))
            held.clear()
            begins = _prefix_hashes(matrix)
            # the first beginning whose cell is not crowded; all words if all are
            roomy = ~crowded[(begins >> np.uint64(48)).astype(np.int64)]
            roomy[:, -1] = True
            by = roomy.argmax(axis=1)
            key = begins[np.arange(len(begins)), by]
            bucket = (key % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            matrix, weight, by, bucket = matrix[order], weight[order], by[order] + 2, bucket[order]
            cuts = np.flatnonzero(np.diff(bucket)) + 1
            bounds = np.concatenate([[0], cuts, [len(bucket)]]).tolist()
            codes, known = numbers.of(matrix)
            parts = [slice(a, b) for a, b in zip(bounds, bounds[1:])]
            blobs = [pack(matrix[p], codes[p], known[p], weight[p], by[p]) for p in parts]
            return pa.RecordBatch.from_pydict(
                {"bucket": pa.array(bucket[bounds[:-1]]), "blob": pa.array(blobs, pa.binary())}
            )

        for batch in batches:
            langs = batch["lang"].to_pylist()
            salts = _salts(langs) if langs else np.empty(0, np.uint64)
            for block, offs, at in _blocks(batch["text"]):
                for data, bounds in _parts(block, offs):
                    found = hasher.words(data, bounds, salts[at : at + len(bounds) - 1])
                    kept = in_bitmap(words, WORD_BITS, found.hashes)
                    own = suffixes(found, kept)
                    if len(own):
                        held.append(own)
                    if sum(map(len, held)) >= CHUNK:
                        yield packed()
        if held:
            yield packed()

    return route


def _bucket_counter(sent: Broadcast, least: int):
    """Count the phrases of each bucket; rows come sorted by bucket."""

    def count(blobs: list[bytes]) -> Iterator[pa.RecordBatch]:
        common = sent.value[2]
        found = [unpack(blob) for blob in blobs]
        rest = np.unique(np.concatenate([f[1] for f in found]))
        hashes = np.concatenate([np.zeros(1, np.uint64), common, rest])
        numbers = []
        for codes, own, _, _ in found:
            # the dictionary of one blob to that of the bucket
            to = np.arange(COMMON + 1 + len(own))
            to[COMMON + 1 :] = 1 + len(common) + np.searchsorted(rest, own)
            numbers.append(to[codes].astype(np.int32))
        suffixes_ = np.concatenate(numbers)
        weight = np.concatenate([f[2] for f in found])
        routed = np.concatenate([f[3] for f in found])
        del found, numbers
        for by in np.unique(routed).tolist():
            own = routed == by
            suffix = suffixes_[own]
            for length, example, total in multikey_quicksort(suffix, weight[own], least, by):
                values = signed(hashes[suffix[example, :length]])
                lists = pa.ListArray.from_arrays(
                    np.arange(0, len(example) * length + 1, length, dtype=np.int32),
                    pa.array(values.ravel()),
                )
                yield pa.RecordBatch.from_pydict({"ws": lists, "a": pa.array(total)})

    def count_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, blobs = None, []
        for batch in batches:
            for bucket, blob in zip(batch["bucket"].to_pylist(), batch["blob"].to_pylist()):
                if bucket != current and blobs:
                    yield from count(blobs)
                    blobs = []
                current = bucket
                blobs.append(blob)
        if blobs:
            yield from count(blobs)

    return count_all


# ---------------------------------------------------------------- operator


def count_phrases(docs: DataFrame, least: int = 100) -> tuple[DataFrame, DataFrame]:
    """(words, phrases): counts of every word, and of phrases met ``least`` times or more.

    ``words`` has hash, lang, word, n; ``phrases`` has ws (word hashes) and a.
    """
    spark = docs.sparkSession
    source = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), whole_text().alias("text")
    )
    with small_batches(spark):
        rows = source.mapInArrow(_word_table, "hash long, lang string, word string, n long")
        counted = stage(
            rows.groupBy("hash", "lang").agg(F.min("word").alias("word"), F.sum("n").alias("n")),
            "phrase-words",
        )
    words = counted.where("lang is not null")
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    frequent = words.where(F.col("n") >= least)
    crowded = np.zeros(SKETCH, bool)
    over = counted.where(F.col("lang").isNull() & (F.col("n") * WIDE > total))
    for (cell,) in over.select("hash").collect():  # at most SKETCH rows
        crowded[cell] = True
    # at most COMMON rows
    common = frequent.orderBy(F.desc("n"), "hash").limit(COMMON).select("hash").toArrow()
    common = common["hash"].to_numpy().view(np.uint64)
    kept = bitmap(frequent, F.col("hash"), WORD_BITS)
    sent = spark.sparkContext.broadcast((kept, crowded, common))
    buckets = max(32, total // BUCKET)
    with small_batches(spark):
        routed = source.mapInArrow(_router(sent, buckets), "bucket long, blob binary")
        phrases = (
            routed.repartition("bucket")
            .sortWithinPartitions("bucket")
            .mapInArrow(_bucket_counter(sent, least), "ws array<long>, a long")
            .groupBy("ws")
            .agg(F.sum("a").alias("a"))
            .where(F.col("a") >= least)
        )
        return words, stage(phrases, "phrases")


def _scored(words: DataFrame, phrases: DataFrame, asked: DataFrame, least: int) -> DataFrame:
    """The phrases asked for with their language's n and their lowest-scoring cut."""
    salts = 16
    frequent = words.where(F.col("n") >= least)
    # single words begin and end many phrases, so their counts are spread over salts
    singles = frequent.select(
        F.array("hash").alias("ws"),
        F.col("n").alias("f"),
        F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"),
    )
    counts = singles.unionByName(
        phrases.where(F.size("ws") < DEPTH).select("ws", F.col("a").alias("f"), F.lit(0).alias("salt"))
    )
    sizes = words.groupBy("lang").agg(F.sum("n").alias("n"))
    langs = frequent.select(F.col("hash").alias("first"), "lang")
    salt = F.pmod(F.hash("ws"), F.lit(salts))
    cuts = asked.select(
        "ws", "a", salt.alias("own"), F.explode(F.sequence(F.lit(1), F.size("ws") - 1)).alias("k")
    )
    left = F.slice("ws", 1, F.col("k"))
    right = F.slice("ws", F.col("k") + 1, F.size("ws") - F.col("k"))
    salted = lambda part: F.when(F.size(part) == 1, F.col("own")).otherwise(0)
    cuts = cuts.select("*", left.alias("left"), right.alias("right"))
    for side in ("left", "right"):
        found = counts.select(
            F.col("ws").alias(side), F.col("salt").alias(f"salt_{side}"), F.col("f").alias(f"f_{side}")
        )
        cuts = cuts.withColumn(f"salt_{side}", salted(side)).join(found, [side, f"salt_{side}"])
    first = cuts.withColumn("first", F.col("ws")[0])
    with_lang = first.join(langs, "first").join(sizes, "lang")
    product = F.col("f_left").cast("decimal(18,0)") * F.col("f_right").cast("decimal(18,0)")
    above = (F.col("a") * 1000).cast("decimal(19,0)") * F.col("n").cast("decimal(18,0)")
    score = F.expr("above div product")
    scored = with_lang.withColumn("above", above).withColumn("product", product)
    return (
        scored.withColumn("score", score)
        .groupBy("ws", "a", "lang", "n")
        .agg(
            F.min(
                F.struct("score", "k", F.col("f_left").alias("l"), F.col("f_right").alias("r"))
            ).alias("cut")
        )
        .select("ws", "lang", "a", "n", "cut.l", "cut.r", "cut.score")
    )


def _not_inside(phrases: DataFrame, inside_percent: int) -> DataFrame:
    """Phrases that no longer one holds with ``inside_percent`` of their occurrences.

    A longer phrase that holds one occurs no oftener than the phrases between them, so the
    phrases of one word more decide.
    """
    longer = phrases.where(F.size("ws") > 2).select(
        F.explode(
            F.array(
                F.slice("ws", 1, F.size("ws") - 1), F.slice("ws", F.lit(2), F.size("ws") - 1)
            )
        ).alias("ws"),
        F.col("a").alias("longer"),
    )
    most = longer.groupBy("ws").agg(F.max("longer").alias("longer"))
    held = F.col("longer") * 100 >= F.col("a") * inside_percent
    return phrases.join(most, "ws", "left").where(~F.coalesce(held, F.lit(False))).drop("longer")


def collocations(
    docs: DataFrame, least: int = 100, first: int = 2000, inside_percent: int = 100
) -> DataFrame:
    """Each language's ``first`` phrases by score: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z), split into pieces at ``.,;:!?`` and line ends and into
    words at spaces and tabs.  A null language counts as ``und``, a null text as empty; a
    table without frequent phrases gives no rows.  Repeated rows count as often as they
    occur.  Ties go to the more frequent, then to the least phrase in byte order.  Other
    columns are not read.  Long texts are worked through in parts that end with a piece.
    A 64-bit hash stands for a word of a language.
    """
    words, phrases = count_phrases(docs, least)
    scored = _scored(words, phrases, _not_inside(phrases, inside_percent), least)
    # rows beyond the first ranks with their ties can go before the words are looked up
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    ranked = scored.withColumn("_near", F.rank().over(best)).where(F.col("_near") <= first)
    ranked = ranked.drop("_near")
    spelled = (
        ranked.select("*", F.posexplode("ws").alias("at", "hash"))
        .join(words.select("hash", "word"), "hash")
        .groupBy("lang", "ws", "a", "l", "r", "n", "score")
        .agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("found"))
        .withColumn("phrase", F.array_join(F.transform("found", lambda w: w["word"]), " "))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        spelled.withColumn("rank", F.row_number().over(order).cast("long"))
        .where(F.col("rank") <= first)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
