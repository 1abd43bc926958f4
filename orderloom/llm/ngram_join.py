"""Exact Jaccard self-join of documents over word n-grams, as a blocked sparse product.

The incidence matrix A has a row per distinct shingle set and a column per n-gram.  The
columns are ordered from rare to frequent.  A row's leading block are its first
|x| - ceil(t |x|) + 1 columns in that order: two rows that reach the threshold t share
columns there, because of the sizes alone.  The product of the leading blocks gives a cell
to a pair only where the columns that are left behind the shared one can still reach the
overlap that the two sizes ask for.

Each row also has its columns folded into about as many blocks as it has columns, with one
bit per block: whether its count there is odd.  Where the bits of two rows differ, at least
one column is in one of them only, so the number of such blocks bounds their overlap from
above, and pairs whose bound is below what their sizes ask for are dropped.  The bound never
drops a link.  Pairs that it leaves have their overlap counted from both whole texts.

A group of m near copies would fill m * m / 2 cells.  Each row is first linked to the
most central row it shares a leading column with (a star), counted exactly; the product is
then taken only for pairs that no star connects, with the rows outside the largest star
of a column on one side.  All links between rows outside a common star are found, so the
components are exact; links inside a star are not listed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import (
    bitmap,
    in_bitmap,
    small_batches,
    staged_with_row,
    summed_counts,
    whole_text,
)
from orderloom.llm.components import components
from orderloom.llm.textscan import (
    LOWER,
    SPACE,
    WordHasher,
    bounds_of,
    mix,
    ngrams,
    row_sums,
    shingles,
    signed,
)
from orderloom.scratch import stage

SKETCH_BITS = 20
WANTED_BITS = 22
PARTNERS = 512
WIDE = 1 << 20  # columns of cells with a greater count are not looked up one by one


@dataclass(frozen=True)
class Threshold:
    """Jaccard similarity of at least num / 100, in whole numbers."""

    percent: int = 85

    def holds(self, overlap: Column, n: Column, m: Column) -> Column:
        return overlap * (100 + self.percent) >= (n + m) * self.percent

    def least_overlap(self, n: Column, m: Column) -> Column:
        total = 100 + self.percent
        return F.floor(((n + m) * self.percent + (total - 1)) / total)

    def sizes_fit(self, n: Column, m: Column) -> Column:
        return F.least(n, m) * 100 >= F.greatest(n, m) * self.percent

    def least_in_lead(self, n: Column, m: Column) -> Column:
        """Columns that two rows of these sizes must share in their leading blocks."""
        behind = F.floor((F.greatest(n, m) * self.percent + 99) / 100) - 1
        return F.greatest(self.least_overlap(n, m) - behind, F.lit(1))

    def most_apart(self, n: Column, m: Column) -> Column:
        """Columns that rows of these sizes may have in one of them only."""
        return n + m - 2 * self.least_overlap(n, m)

    def lead_length(self, n: np.ndarray) -> np.ndarray:
        return n - (n * self.percent + 99) // 100 + 1

    def lead_of(self, n: Column) -> Column:
        return n - F.floor((n * self.percent + 99) / 100) + 1


def column_levels(docs: DataFrame, size: int) -> tuple[np.ndarray, int]:
    """How frequent the columns of each cell of a fixed-size sketch are, in powers of two.

    Level 0 are cells with up to about twice the mean count.  The order only decides how
    much work the join is, never its result.  The number is the first level of which all
    counts are above ``WIDE``.
    """
    cells, shift = 1 << SKETCH_BITS, np.uint64(64 - SKETCH_BITS)

    hashers: list[WordHasher] = []  # one per task

    def count(batch: pa.RecordBatch, total: np.ndarray) -> None:
        if not hashers:
            hashers.append(WordHasher(SPACE, LOWER))
        for _, _, hashes, rows in hashers[0].blocks(batch["text"]):
            grams, _ = ngrams(hashes, rows, tuple(range(size)))
            np.add.at(total, (grams >> shift).astype(np.int64), 1)

    counts = summed_counts(docs.select("text"), count, cells)
    floor = 2 * counts.mean() + 8
    levels = np.floor(np.log2(np.maximum(counts, 1) / floor)) + 1
    wide = max(int(np.ceil(np.log2(WIDE / floor))) + 1, 1)
    return np.clip(levels, 0, 60).astype(np.uint8), wide


def odd_blocks(grams: np.ndarray, owner: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row a bit for each block of its columns, set where their count is odd.

    A row of n columns has the least power of two of blocks, 64 or more, that is not below
    n; they come as 64-bit words with the bounds of each row.  A row with twice the blocks
    is folded onto half of them by xor.
    """
    exponent = np.ceil(np.log2(np.maximum(n, 64))).astype(np.int64)
    blocks = np.where(n > 0, np.int64(1) << exponent, 0)
    starts = np.concatenate([[0], np.cumsum(blocks)])
    inside = (grams & (blocks[owner] - 1).astype(np.uint64)).astype(np.int64)
    odd = np.bincount(starts[owner] + inside, minlength=starts[-1]) & 1
    words = np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8")
    return words, starts >> 6


def shingle_rows(
    docs: DataFrame, levels: np.ndarray, wide: int, size: int, threshold: Threshold
) -> DataFrame:
    """Per row: n, a 128-bit signature of its shingle set, its odd blocks, its leading block
    and how many columns of that are below the level ``wide``."""
    shift = np.uint64(64 - SKETCH_BITS)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(SPACE, LOWER)
        for batch in batches:
            ids, keys = batch["_row"], batch["doc_id"]
            for lo, hi, hashes, rows in hasher.blocks(batch["text"]):
                count = hi - lo
                grams, owner = shingles(hashes, rows, count, size)
                bounds = bounds_of(owner, count)
                n = np.diff(bounds)
                level = levels[(grams >> shift).astype(np.int64)]
                order = np.lexsort((level, owner))  # stable: by hash inside a level
                place = np.arange(len(grams)) - bounds[owner]
                leading = place < threshold.lead_length(n)[owner]
                lead = grams[order][leading]
                narrow = leading & (level[order] < wide)
                odd, odd_ends = odd_blocks(grams, owner, n)
                ends = np.concatenate([[0], np.cumsum(np.where(n, threshold.lead_length(n), 0))])
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(lo, count),
                        keys.slice(lo, count),
                        pa.array(n.astype(np.int64)),
                        pa.array(signed(row_sums(mix(grams), bounds))),
                        pa.array(signed(row_sums(mix(~grams), bounds))),
                        pa.ListArray.from_arrays(
                            pa.array(odd_ends.astype(np.int32)), pa.array(odd)
                        ),
                        pa.array(np.bincount(owner[narrow], minlength=count)),
                        pa.ListArray.from_arrays(
                            pa.array(ends.astype(np.int32)), pa.array(signed(lead))
                        ),
                    ],
                    names=["_row", "doc_id", "n", "s1", "s2", "odd", "narrow", "lead"],
                )

    key = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("_row", "doc_id", "text").mapInArrow(
        scan,
        f"_row long, doc_id {key}, n long, s1 long, s2 long, odd array<long>, narrow long, "
        "lead array<long>",
    )


def _overlaps(texts: DataFrame, size: int) -> DataFrame:
    """Rows (a, b, na, nb, overlap) from rows (a, salt, b, na, nb, text).

    The rows of an (a, salt) are together and in order, the first with the text of a and
    no b.  Its set is kept while the rows of its partners go by.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(SPACE, LOWER)
        first, own = None, np.empty(0, np.uint64)
        for batch in batches:
            lefts, rights = batch["a"].to_numpy(), batch["b"].is_null().to_numpy(False)
            places, both = [], []
            for lo, hi, hashes, rows in hasher.blocks(batch["text"]):
                grams, owner = shingles(hashes, rows, hi - lo, size)
                bounds = bounds_of(owner, hi - lo)
                for row in range(lo, hi):
                    found = grams[bounds[row - lo] : bounds[row - lo + 1]]
                    if rights[row]:
                        first, own = lefts[row], found.copy()
                    elif first == lefts[row]:
                        places.append(row)
                        both.append(len(np.intersect1d(own, found, assume_unique=True)))
            if places:
                kept = batch.take(pa.array(places))
                yield pa.RecordBatch.from_arrays(
                    [kept["a"], kept["b"], kept["na"], kept["nb"], pa.array(both, pa.int64())],
                    names=["a", "b", "na", "nb", "overlap"],
                )

    return texts.mapInArrow(count, "a long, b long, na long, nb long, overlap long")


def _counted(pairs: DataFrame, docs: DataFrame, size: int, label: str) -> DataFrame:
    """The pairs with their overlap, counted over whole texts; written.

    Only the texts of rows in a pair move: a bitmap of fixed size lets through those and
    a few others before the shuffle, the join then drops the others.  The text of a goes
    once to each salted part of at most about PARTNERS of its pairs, so neither the text
    of a hub is copied per pair, nor do all its pairs meet in one task.
    """
    mark = F.xxhash64("row")
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("row"))
    words = bitmap(wanted, mark, WANTED_BITS)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = in_bitmap(words, WANTED_BITS, batch["mark"].to_numpy().view(np.uint64))
            if hit.any():
                yield batch.select(["row", "text"]).filter(pa.array(hit))

    marked = docs.select(F.col("_row").alias("row"), "text").withColumn("mark", mark)
    texts = stage(marked.mapInArrow(pick, "row long, text string"), f"{label}-texts")
    parts = pairs.groupBy("a").agg(F.ceil(F.count("*") / F.lit(PARTNERS)).alias("parts"))
    salted = pairs.join(parts, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("parts")))
    hubs = salted.select("a", "salt", "na").distinct()
    none = F.lit(None).cast("long")
    firsts = hubs.join(texts.withColumnRenamed("row", "a"), "a").select(
        "a", "salt", none.alias("b"), "na", none.alias("nb"), "text"
    )
    others = salted.join(texts.withColumnRenamed("row", "b"), "b").select(
        "a", "salt", "b", "na", "nb", "text"
    )
    together = (
        firsts.unionAll(others)
        .repartition("a", "salt")
        .sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    )
    return stage(_overlaps(together, size), label)


def _within(
    pairs: DataFrame, odd: DataFrame, threshold: Threshold, slack: int = 1
) -> DataFrame:
    """The pairs whose odd blocks leave them at most ``slack`` times as far apart as allowed.

    Only the pairs and a bit per column move, not the texts.
    """
    one, other = F.col("odd_a"), F.col("odd_b")
    short = F.when(F.size(one) <= F.size(other), one).otherwise(other)
    long = F.when(F.size(one) <= F.size(other), other).otherwise(one)
    of_a = odd.select(F.col("_row").alias("a"), F.col("odd").alias("odd_a"))
    of_b = odd.select(F.col("_row").alias("b"), F.col("odd").alias("odd_b"))
    both = pairs.join(of_a, "a").join(of_b, "b")
    both = both.select("a", "b", "na", "nb", short.alias("short"), long.alias("long"))

    def differ(word: Column, at: Column) -> Column:
        folded = F.sequence(at, F.size("long") - 1, F.size("short"))
        return F.bit_count(
            F.aggregate(folded, word, lambda x, i: x.bitwiseXOR(F.get("long", i)))
        )

    apart = F.aggregate(F.transform("short", differ), F.lit(0), lambda x, y: x + y)
    most = threshold.most_apart(F.col("na"), F.col("nb")) * slack
    return both.where(apart <= most).select("a", "b", "na", "nb")


def _linked(counted: DataFrame, threshold: Threshold) -> DataFrame:
    holds = threshold.holds(F.col("overlap"), F.col("na"), F.col("nb"))
    return counted.where(holds).select("a", "b")


def _star_counts(
    entries: DataFrame, odd: DataFrame, docs: DataFrame, size: int, threshold: Threshold
) -> DataFrame:
    """Each row's overlap with the most central row it shares columns with.

    Central is the row with the greatest share of its leading block in other rows, so a
    group's links meet in few rows.  Rows are ordered by (share, id), which makes the
    links a forest.  A row that is beyond twice the allowed distance from it is not counted:
    its distance would tell little about others.
    """
    place = F.struct("share", "node", "n", "c")
    hubs = entries.groupBy("gram").agg(F.max(place).alias("hub"))
    near = entries.join(hubs, "gram").where(F.col("node") != F.col("hub.node"))
    na, nb = F.col("hub.n"), F.col("n")
    fits = threshold.sizes_fit(na, nb) & (
        F.least("c", "hub.c") >= threshold.least_in_lead(na, nb)
    )
    counted = (
        near.where(fits)
        .groupBy("node", "n", F.col("hub.node").alias("a"), F.col("hub.n").alias("na"))
        .agg(F.count("*").alias("shared"))
    )
    best = counted.groupBy("node", "n").agg(F.max(F.struct("shared", "a", "na")).alias("best"))
    pairs = best.select(
        "best.a", F.col("node").alias("b"), "best.na", F.col("n").alias("nb")
    )
    near = _within(stage(pairs, "star-pairs"), odd, threshold, slack=2)
    return _counted(stage(near, "near-stars"), docs, size, "star-counts")


def _product_pairs(entries: DataFrame, counted: DataFrame, threshold: Threshold) -> DataFrame:
    """Pairs of rows in different stars that can share enough of their leading blocks.

    A pair that shares k columns shares one that has k - 1 more behind it in both blocks.
    The first column that two rows share begins a run: the columns before it differ.  So a
    cell is made only at the beginning of a run with enough room behind it, which drops no
    pair, instead of once per shared column.  Two rows that were counted against the same
    hub are at least as far apart as their distances to it differ.
    """
    stars = _linked(counted, threshold)
    up = stars.select(F.col("b").alias("node"), F.col("a").alias("up"))
    # two steps up the forest; what is left apart only costs work
    top = up.join(up.select(F.col("node").alias("up"), F.col("up").alias("above")), "up", "left")
    root = top.select("node", F.coalesce("above", "up").alias("root"))
    apart = counted.select(
        F.col("b").alias("node"),
        F.col("a").alias("hub"),
        (F.col("na") + F.col("nb") - 2 * F.col("overlap")).alias("far"),
    )
    known = apart.join(root, "node", "left")
    rooted = stage(
        entries.join(known, "node", "left").select(
            "gram", "node", "n", "c", "room", "before",
            F.coalesce("root", "node").alias("root"),
            F.coalesce("hub", "node").alias("hub"),
            F.coalesce("far", F.lit(0)).alias("far"),
        ),
        "rooted",
    )
    by_root = rooted.groupBy("gram", "root").agg(F.count("*").alias("rows"))
    main = by_root.groupBy("gram").agg(F.max(F.struct("rows", "root")).alias("main"))
    placed = rooted.join(main, "gram").select(
        "gram", "node", "n", "c", "root", "before", "room", "hub", "far",
        (F.col("root") == F.col("main.root")).alias("main"),
    )
    names = ("node", "n", "c", "root", "before", "room", "hub", "far")
    a = placed.where(~F.col("main")).select("gram", *[F.col(c).alias(f"{c}_a") for c in names])
    b = placed.select("gram", "main", *[F.col(c).alias(f"{c}_b") for c in names])
    na, nb = F.col("n_a"), F.col("n_b")
    least = threshold.least_in_lead(na, nb)
    pairs = a.join(b, "gram").where(
        (F.col("root_a") != F.col("root_b"))
        & (F.col("main") | (F.col("node_a") < F.col("node_b")))
        & threshold.sizes_fit(na, nb)
        & (F.least("c_a", "c_b", "room_a", "room_b") >= least)
        & (
            (F.col("hub_a") != F.col("hub_b"))
            | (F.abs(F.col("far_a") - F.col("far_b")) <= threshold.most_apart(na, nb))
        )
        & ~F.coalesce(F.col("before_a") == F.col("before_b"), F.lit(False))
    )
    # a pair can meet in either order, as the main star differs from column to column
    swap = F.col("node_a") > F.col("node_b")
    return pairs.select(
        F.least("node_a", "node_b").alias("a"),
        F.greatest("node_a", "node_b").alias("b"),
        F.when(swap, nb).otherwise(na).alias("na"),
        F.when(swap, na).otherwise(nb).alias("nb"),
    ).distinct()


def jaccard_rows(
    docs: DataFrame, size: int = 4, threshold: Threshold = Threshold()
) -> tuple[DataFrame, DataFrame]:
    """Rows with their class and component; ``docs`` is a written table with ``_row``.

    The first frame has (_row, doc_id, n, component) per row of ``docs``, the second the
    links (a, b) between classes that were counted, by the least ``_row`` of each class.
    """
    with small_batches(docs.sparkSession):
        return _jaccard_rows(docs, size, threshold)


def _jaccard_rows(
    docs: DataFrame, size: int, threshold: Threshold
) -> tuple[DataFrame, DataFrame]:
    levels, wide = column_levels(docs, size)
    scanned = stage(shingle_rows(docs, levels, wide, size, threshold), "shingle-rows")
    narrow, odd = scanned.select("_row", "doc_id", "n", "s1", "s2"), scanned.select("_row", "odd")
    classes = stage(
        narrow.where("n > 0").groupBy("s1", "s2").agg(F.min("_row").alias("node")), "classes"
    )
    leads = scanned.join(classes.select(F.col("node").alias("_row")), "_row", "left_semi")
    column = ["node", "n", F.col("col").alias("gram"), (F.col("p") - F.col("pos")).alias("room")]

    def columns(some: DataFrame) -> DataFrame:
        return some.select(
            F.col("_row").alias("node"), "n", "narrow", F.size("lead").alias("p"), F.posexplode("lead")
        )

    # columns that other rows have too: one shuffle, in which no column has more rows than
    # a cell below the level has; those of wider cells go on unseen, as passing a column too
    # many costs only work
    rows = F.count("*").over(Window.partitionBy("gram"))
    below = columns(leads).where("pos < narrow").select(*column).withColumn("rows", rows)
    beyond = columns(leads.where("narrow < size(lead)")).where("pos >= narrow").select(*column)
    common = below.where("rows > 1").drop("rows").unionByName(beyond)
    # a window holds the leading block of one row; a column that no other row has ends a run
    own = Window.partitionBy("node")
    inside = own.orderBy(F.col("room").desc())
    beside = F.lag("room").over(inside) == F.col("room") + 1
    share = F.col("c") / threshold.lead_of(F.col("n"))
    entries = stage(
        common.withColumn("c", F.count("*").over(own))
        .withColumn("before", F.when(beside, F.lag("gram").over(inside)))
        .select("gram", "node", "n", "c", "room", "before", share.alias("share")),
        "entries",
    )
    stars = _star_counts(entries, odd, docs, size, threshold)
    pairs = stage(_product_pairs(entries, stars, threshold), "product-pairs")
    pairs = stage(_within(pairs, odd, threshold), "product-bounded")
    both = stars.unionAll(_counted(pairs, docs, size, "product-counts"))
    links = _linked(both, threshold)
    groups = components(links, "a", "b")
    of_class = classes.join(groups, "node", "left").select(
        "s1", "s2", F.coalesce("component", "node").alias("component")
    )
    joined = narrow.join(of_class, ["s1", "s2"], "left").select(
        "_row", "doc_id", "n", F.when(F.col("n") > 0, F.col("component")).alias("component")
    )
    return joined, links


def near_duplicate_components(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    size: int = 4,
    threshold: Threshold = Threshold(),
) -> DataFrame:
    """doc_id, n_shingles and component_id of each document.

    Words are runs without ASCII white space, with A-Z in lower case; the set are the
    distinct shingles of ``size`` words, or the whole sequence of a shorter text.  Texts
    without words (null, empty, blank) have size 0 and link with nothing.  component_id is
    the smallest doc_id of the component; a null id counts last, and rows that repeat an
    id are documents of their own.  A whole 64-bit hash stands for a shingle and 128 bits
    for a set.  Empty tables give no rows; other columns are not read.
    """
    own = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    kept = staged_with_row(own.withColumn("text", whole_text()), "join-docs")
    rows, _ = jaccard_rows(kept, size, threshold)
    rows = stage(rows, "jaccard-rows")
    least = rows.groupBy("component").agg(F.min("doc_id").alias("least"))
    placed = rows.join(least, "component", "left")
    return placed.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("least", "doc_id").alias("component_id"),
    )


def one_of_each_group(
    docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5,
    threshold: Threshold = Threshold(80),
) -> DataFrame:
    """The documents that stay: of each component the row with the smallest id.

    Rows with a null id come last, equal ids are told apart by their place in the table.
    Texts without words all stay.
    """
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_doc"))
    kept = staged_with_row(packed, "near-duplicates")
    plain = kept.select(
        "_row", F.col(f"_doc.`{key}`").alias("doc_id"), whole_text(f"_doc.`{text}`").alias("text")
    )
    rows, _ = jaccard_rows(plain, size, threshold)
    rows = stage(rows.where("component is not null"), "jaccard-rows")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "_row")
    stays = rows.groupBy("component").agg(F.min(place).alias("first"))
    goes = rows.join(stays, "component").where("_row != first._row").select("_row")
    goes = stage(goes, "duplicates")
    return kept.join(goes, "_row", "left_anti").select("_doc.*")
