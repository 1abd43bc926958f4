"""Hard negatives of anchors: rows of another label that score close below a positive.

Vectors become whole numbers, so scores are exact inner products.  Anchors are put in
blocks of bounded size, near ones together, and each block gets a minimum spanning tree.
A block is sent to all tasks, and each task walks the tree over its own rows, a few
thousand at a time: the root is scored against every row; at a child, a row's score lies
within the parent's bounds, plus or minus the length of the edge times the row's norm
(Cauchy and Schwarz).  Only rows whose bounds meet the window in question are scored again,
which also makes their bounds exact for the children.  One walk finds the positives (the
window is what the weakest positive so far leaves open), another the negatives (the window
follows from each positive, and rises while better negatives turn up).

Rows are never shuffled and never leave their task; a task reports a fixed number of rows
per anchor and block.  Every row is held against every anchor's bounds, so the work is
rows times anchors, in blocks, and the results are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.operators.ordering import with_row_number
from orderloom.scratch import stage

BLOCK_BYTES = 16 << 20  # of anchors that are sent to the tasks at a time
BLOCK_ANCHORS = 2048
ROWS = 4096  # rows that walk a tree together
SAFE = 2.0**26  # vectors up to this norm have inner products that doubles hold exactly
PLANES = 16  # sides of random planes that say which anchors are near

_LONG = 2**63 - 1


class Rows(NamedTuple):
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray  # whole numbers in doubles
    norms: np.ndarray


class AnchorBlock(NamedTuple):
    """Anchors in an order in which parents come before their children."""

    rows: Rows
    parents: np.ndarray  # -1 at the root
    edges: np.ndarray


def whole_vectors(column: pa.Array, scale: float, width: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(vectors as floor(scale * x), usable): null vectors and those with a null or
    non-finite component are not usable.  Shorter ones are filled with 0 to ``width``."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.asarray(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), np.int64)
    usable = ~column.is_null().to_numpy(zero_copy_only=False)
    bad = np.zeros(len(flat) + 1, np.int64)
    np.cumsum(~np.isfinite(flat), out=bad[1:])
    ends = np.cumsum(sizes)
    usable &= bad[ends] == bad[ends - sizes]
    width = int(sizes.max(initial=0)) if width is None else width
    out = np.zeros((n, width))
    row = np.repeat(np.arange(n), sizes)
    at = np.arange(len(flat)) - np.repeat(ends - sizes, sizes)
    take = usable[row] & (at < width)
    out[row[take], at[take]] = np.floor(scale * flat[take])
    return out, usable


def rows_of(batch: pa.RecordBatch, scale: float, width: int | None = None) -> Rows:
    vectors, usable = whole_vectors(batch["vector"], scale, width)
    ids = batch["id"].to_numpy(zero_copy_only=False)[usable]
    labels = batch["label"].to_numpy(zero_copy_only=False)[usable]
    vectors = vectors[usable]
    with np.errstate(over="ignore"):
        # hypot-like scaling is not needed: a norm that overflows is above SAFE all the same
        norms = np.sqrt((vectors * vectors).sum(axis=1))
    return Rows(ids, labels, vectors, norms)


def exact_scores(vectors: np.ndarray, anchor: np.ndarray, safe: bool) -> np.ndarray:
    """Inner products; beyond what doubles hold, with whole numbers of any size."""
    if safe:
        return vectors @ anchor
    wide = [int(x) for x in anchor.tolist()]
    sums = [sum(int(x) * y for x, y in zip(row, wide)) for row in vectors.tolist()]
    return np.array([float(max(-_LONG, min(_LONG, s))) for s in sums])


def spanning_tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimum spanning tree by Prim, from the vector nearest to the mean:
    (order with parents first, parent's place in that order, edge length)."""
    n = len(vectors)
    order, parents, edges = np.empty(n, np.int64), np.full(n, -1, np.int64), np.zeros(n)
    with np.errstate(over="ignore", invalid="ignore"):
        centre = vectors.mean(axis=0)
        away = np.nan_to_num(((vectors - centre) ** 2).sum(axis=1), nan=np.inf)
        at = int(away.argmin())
        best, link = np.full(n, np.inf), np.full(n, -1, np.int64)
        todo = np.ones(n, bool)
        for place in range(n):
            order[place] = at
            parents[place] = link[at]
            edges[place] = np.sqrt(best[at]) if place else 0.0
            todo[at] = False
            near = np.nan_to_num(((vectors - vectors[at]) ** 2).sum(axis=1), nan=np.inf)
            closer = todo & ((near < best) | (link < 0))
            best[closer], link[closer] = near[closer], place
            if place + 1 < n:
                open_ = np.flatnonzero(todo)
                at = int(open_[best[open_].argmin()])
    return order, parents, edges


# ---------------------------------------------------------------- the walk


class _Best:
    """The first ``most`` (score, id) pairs of a slot, best first."""

    def __init__(self, slots: int, most: int):
        self.most = most
        self.scores = np.full((slots, most), -np.inf)
        self.ids = np.zeros((slots, most), np.int64)

    def floor(self, slot: int) -> float:
        return self.scores[slot, -1]

    def add(self, slot: int, scores: np.ndarray, ids: np.ndarray) -> None:
        scores = np.concatenate([self.scores[slot], scores])
        ids = np.concatenate([self.ids[slot], ids])
        if len(scores) > 4 * self.most:
            least = np.partition(scores, -self.most)[-self.most]
            near = scores >= least
            scores, ids = scores[near], ids[near]
        first = np.lexsort((ids, -scores))[: self.most]
        self.scores[slot], self.ids[slot] = scores[first], ids[first]

    def batch(self, **slots: np.ndarray) -> pa.RecordBatch:
        slot, place = np.nonzero(self.scores > -np.inf)
        columns = {name: pa.array(values[slot]) for name, values in slots.items()}
        columns["found_id"] = pa.array(self.ids[slot, place])
        found = self.scores[slot, place]
        held = np.where(np.abs(found) < 2.0**63, found, 0).astype(np.int64)
        held[found >= 2.0**63], held[found <= -(2.0**63)] = _LONG, -_LONG
        columns["score"] = pa.array(held)
        return pa.RecordBatch.from_pydict(columns)


class _Walk:
    """Bounds of the scores of some rows at one anchor after the other."""

    def __init__(self, block: AnchorBlock, rows: Rows):
        self.block, self.rows = block, rows
        self.safe_rows = rows.norms <= SAFE
        self.all_safe = bool(self.safe_rows.all())
        self.waiting = np.bincount(block.parents[block.parents >= 0], minlength=len(block.parents))
        self.bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def enter(self, t: int) -> tuple[np.ndarray, np.ndarray]:
        parent = self.block.parents[t]
        if parent < 0:
            scores = self._scores(t, np.arange(len(self.rows.ids)))
            return scores, scores.copy()
        low, high = self.bounds[parent]
        with np.errstate(over="ignore", invalid="ignore"):
            # a little wider than the product, for what rounding takes away
            reach = self.block.edges[t] * self.rows.norms * (1 + 1e-9) + 1
            low, high = low - reach, high + reach
        if not self.all_safe or not np.isfinite(self.block.edges[t]):
            low[~(low > -np.inf)], high[~(high < np.inf)] = -np.inf, np.inf
        self.waiting[parent] -= 1
        if not self.waiting[parent]:
            del self.bounds[parent]
        return low, high

    def _scores(self, t: int, at: np.ndarray) -> np.ndarray:
        anchor = self.block.rows.vectors[t]
        if self.block.rows.norms[t] <= SAFE and (self.all_safe or self.safe_rows[at].all()):
            if 2 * len(at) > len(self.rows.ids):
                return (self.rows.vectors @ anchor)[at]
            return exact_scores(self.rows.vectors[at], anchor, True)
        return np.array(
            [
                exact_scores(
                    self.rows.vectors[i : i + 1],
                    anchor,
                    bool(self.safe_rows[i] and self.block.rows.norms[t] <= SAFE),
                )[0]
                for i in at
            ]
        )

    def rescore(self, t: int, low: np.ndarray, high: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact scores of the wanted rows, which also close their bounds."""
        at = np.flatnonzero(wanted)
        if not len(at):
            return at, np.empty(0)
        known = low[at] == high[at]
        scores = low[at]
        if not known.all():
            scores = scores.copy()
            scores[~known] = self._scores(t, at[~known])
            low[at] = high[at] = scores
        return at, scores

    def leave(self, t: int, low: np.ndarray, high: np.ndarray) -> None:
        if self.waiting[t]:
            self.bounds[t] = (low, high)


def _pieces(batches: Iterator[pa.RecordBatch], scale: float, width: int) -> Iterator[Rows]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            rows = rows_of(batch.slice(at, ROWS), scale, width)
            if len(rows.ids):
                yield rows


def _find_positives(sent: Broadcast, scale: float, most: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: AnchorBlock = sent.value
        anchors = block.rows
        best = _Best(len(anchors.ids), most)
        for rows in _pieces(batches, scale, anchors.vectors.shape[1]):
            walk = _Walk(block, rows)
            for t in range(len(anchors.ids)):
                low, high = walk.enter(t)
                wanted = (rows.labels == anchors.labels[t]) & (high >= best.floor(t))
                wanted &= rows.ids != anchors.ids[t]
                at, scores = walk.rescore(t, low, high, wanted)
                open_ = scores >= best.floor(t)
                if open_.any():
                    best.add(t, scores[open_], rows.ids[at[open_]])
                walk.leave(t, low, high)
        yield best.batch(anchor_id=anchors.ids)

    return find


def _find_negatives(sent: Broadcast, scale: float, most: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, slot_anchor, place, bottom, top = sent.value
        anchors = block.rows
        best = _Best(len(place), most)
        slots = [np.flatnonzero(slot_anchor == t) for t in range(len(anchors.ids))]
        for rows in _pieces(batches, scale, anchors.vectors.shape[1]):
            walk = _Walk(block, rows)
            for t in range(len(anchors.ids)):
                low, high = walk.enter(t)
                wanted = np.zeros(len(rows.ids), bool)
                for s in slots[t]:
                    wanted |= (low <= top[s]) & (high >= max(bottom[s], best.floor(s)))
                wanted &= rows.labels != anchors.labels[t]
                at, scores = walk.rescore(t, low, high, wanted)
                for s in slots[t] if len(at) else ():
                    open_ = (scores <= top[s]) & (scores >= max(bottom[s], best.floor(s)))
                    if open_.any():
                        best.add(s, scores[open_], rows.ids[at[open_]])
                walk.leave(t, low, high)
        yield best.batch(anchor_id=anchors.ids[slot_anchor], place=place)

    return find


# ---------------------------------------------------------------- blocks of anchors

_ANCHOR = "id long, label long, vector array<double>"
_BLOCK = "block long, ids binary, labels binary, vectors binary, parents binary, edges binary"


def _sides(planes: np.ndarray):
    """Which side of random planes each anchor lies on, as one number."""

    def sides(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = rows_of(batch, 1.0, planes.shape[0])
            with np.errstate(over="ignore", invalid="ignore"):
                above = rows.vectors @ planes > 0
            code = above @ (1 << np.arange(planes.shape[1]))
            yield pa.RecordBatch.from_pydict(
                {
                    "id": pa.array(rows.ids),
                    "label": pa.array(rows.labels),
                    "vector": pa.array(list(rows.vectors), pa.list_(pa.float64())),
                    "near": pa.array(code.astype(np.int64)),
                }
            )

    return sides


def _with_tree(group: pa.Table) -> pa.Table:
    group = group.combine_chunks().sort_by("rn")
    ids, labels = group["id"].to_numpy(), group["label"].to_numpy()
    vectors, _ = whole_vectors(group["vector"], 1.0)
    order, parents, edges = spanning_tree(vectors)
    return pa.table(
        {
            "block": group["block"][:1],
            "ids": pa.array([ids[order].tobytes()]),
            "labels": pa.array([labels[order].tobytes()]),
            "vectors": pa.array([vectors[order].tobytes()]),
            "parents": pa.array([parents.tobytes()]),
            "edges": pa.array([edges.tobytes()]),
        }
    )


def anchor_blocks(anchors: DataFrame, width: int) -> DataFrame:
    """A written row per block of anchors, each with its spanning tree."""
    spark = anchors.sparkSession
    planes = np.random.default_rng(11).standard_normal((width, PLANES))
    per_block = max(1, min(BLOCK_ANCHORS, BLOCK_BYTES // (8 * max(width, 1))))
    near = anchors.mapInArrow(_sides(planes), _ANCHOR + ", near long")
    numbered = with_row_number(near, ["near", "id"], "rn")
    blocked = numbered.withColumn("block", F.expr(f"(rn - 1) div {per_block}"))
    return stage(blocked.groupBy("block").applyInArrow(_with_tree, _BLOCK), "anchor-blocks")


def _read_block(row, width: int) -> AnchorBlock:
    vectors = np.frombuffer(row["vectors"])
    ids = np.frombuffer(row["ids"], np.int64)
    vectors = vectors.reshape(len(ids), -1) if len(vectors) else np.zeros((len(ids), width))
    with np.errstate(over="ignore"):
        norms = np.sqrt((vectors * vectors).sum(axis=1))
    rows = Rows(ids, np.frombuffer(row["labels"], np.int64), vectors, norms)
    return AnchorBlock(rows, np.frombuffer(row["parents"], np.int64), np.frombuffer(row["edges"]))


# ---------------------------------------------------------------- operator


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    scale: float = 256.0,
    positives: int = 5,
    negatives: int = 3,
    from_percent: int = 50,
    to_percent: int = 95,
) -> DataFrame:
    """For each anchor and each of its first ``positives`` rows of the same label, the first
    ``negatives`` rows of other labels whose score is between ``from_percent`` and
    ``to_percent`` of the positive's.

    Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A component counts as floor(scale * x), a score is the inner product; higher scores come
    first, ties by smaller id.  Rows with a null id, label or vector, or with a null or
    non-finite component, take no part; shorter vectors are filled with 0.  A positive
    without such rows, so also one with a negative score, has no result, and an empty table
    none.  Rows with the same id are rows of their own (but never another's anchor and
    positive at once); of anchors with the same id the one with the least label and vector
    counts.  Scores beyond 64 bits are held at the bounds.  Other columns are not read.
    """
    spark = rows.sparkSession
    source = rows.select(
        F.col(id).cast("long").alias("id"),
        F.col(label).cast("long").alias("label"),
        F.col(vector).cast("array<double>").alias("vector"),
        is_anchor.alias("_anchor"),
    ).where("id is not null and label is not null and vector is not null")
    finite = ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    # floor(scale * x) is taken here for anchors, in the tasks for all other rows
    anchors = stage(
        source.where(F.col("_anchor") & finite)
        .groupBy("id")
        .agg(F.min(F.struct("label", "vector")).alias("first"))
        .select("id", "first.label", "first.vector"),
        "anchors",
    )
    width = anchors.agg(F.coalesce(F.max(F.size("vector")), F.lit(0))).first()[0]
    scaled = anchors.mapInArrow(_scaled(scale, width), _ANCHOR)
    blocks = anchor_blocks(scaled, width)
    numbers = sorted(r["block"] for r in blocks.select("block").collect())  # one per block
    candidates = source.select("id", "label", "vector")

    def walk(number: int, task, what, schema: str) -> DataFrame:
        sent = spark.sparkContext.broadcast(what)
        try:
            return stage(candidates.mapInArrow(task(sent, scale), schema), f"walk-{number}")
        finally:
            sent.unpersist()

    def union(parts: list[DataFrame], schema: str) -> DataFrame:
        return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schema)

    def block(number: int) -> AnchorBlock:
        return _read_block(blocks.where(F.col("block") == number).first(), width)

    schema = "anchor_id long, found_id long, score long"
    met = [
        walk(k, lambda sent, s: _find_positives(sent, s, positives), block(k), schema)
        for k in numbers
    ]
    first = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "found_id")
    chosen = stage(
        union(met, schema)
        .withColumn("place", F.row_number().over(first).cast("long"))
        .where(F.col("place") <= positives)
        .select("anchor_id", "place", F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score")),
        "positives",
    )

    schema = "anchor_id long, place long, found_id long, score long"
    met = []
    for k in numbers:
        own = block(k)
        # at most ``positives`` rows for each anchor of the block
        ids = spark.createDataFrame(pa.table({"anchor_id": own.rows.ids}))
        found = chosen.join(F.broadcast(ids), "anchor_id").toArrow()
        places = {anchor: t for t, anchor in enumerate(own.rows.ids.tolist())}
        slot_anchor = np.array([places[a] for a in found["anchor_id"].to_pylist()], np.int64)
        scores = found["positive_score"].to_pylist()
        bottom = np.array([float(-(-from_percent * p // 100)) for p in scores])
        top = np.array([float(to_percent * p // 100) for p in scores])
        place = found["place"].to_numpy() if len(found) else np.empty(0, np.int64)
        what = (own, slot_anchor, place, bottom, top)
        met.append(walk(k, lambda sent, s: _find_negatives(sent, s, negatives), what, schema))
    first = Window.partitionBy("anchor_id", "place").orderBy(F.desc("score"), "found_id")
    ranked = (
        union(met, schema)
        .withColumn("rank", F.row_number().over(first))
        .where(F.col("rank") <= negatives)
    )
    return ranked.join(chosen, ["anchor_id", "place"]).select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("found_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def _scaled(scale: float, width: int):
    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = rows_of(batch, scale, width)
            yield pa.RecordBatch.from_pydict(
                {
                    "id": pa.array(rows.ids),
                    "label": pa.array(rows.labels),
                    "vector": pa.array(list(rows.vectors), pa.list_(pa.float64())),
                }
            )

    return scaled


def relabelled(embeddings: DataFrame, every: int = 7, labels: int = 10) -> DataFrame:
    """Rows whose id is divisible by ``every`` get the next label."""
    odd = F.col("vec_id") % every == 0
    return embeddings.withColumn(
        "label", F.when(odd, F.pmod(F.col("label") + 1, F.lit(labels))).otherwise(F.col("label"))
    )
