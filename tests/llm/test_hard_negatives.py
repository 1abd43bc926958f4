from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderloom.llm import hard_negatives as module
from orderloom.llm.hard_negatives import hard_negatives, relabelled, spanning_tree, whole_vectors

FIELDS = "vec_id long, embedding array<float>, label int, score string, id string, _anchor int, rank int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash", 7, 8) for r in rows], FIELDS)


def brute(rows, every=10):
    """All scores in plain Python."""
    usable = []
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        usable.append((vec_id, label, [math.floor(256 * float(np.float32(x))) for x in vector]))
    out = []
    for anchor_id, label, anchor in sorted({r[0]: r for r in reversed(sorted(usable, key=lambda r: r[:2]))}.values()):
        if anchor_id % every:
            continue
        scored = [
            (-sum(x * y for x, y in zip(anchor, v)), i, own) for i, own, v in usable if i != anchor_id
        ]
        positives = sorted((s, i) for s, i, own in scored if own == label)[:5]
        for p, positive in positives:
            found = sorted(
                (s, i) for s, i, own in scored
                if own != label and 50 * -p <= 100 * -s <= 95 * -p
            )[:3]
            for rank, (s, i) in enumerate(found, 1):
                out.append((anchor_id, positive, rank, i, -p, -s))
    return sorted(out, key=repr)


def got(df, every=10):
    found = hard_negatives(df, F.col("vec_id") % every == 0)
    return sorted((tuple(r) for r in found.collect()), key=repr)


def clustered(seed, n, width=6, labels=3):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(5)]
    rows = []
    for i in range(n):
        centre = rng.choice(centres)
        rows.append((i, [c + rng.gauss(0, 0.2) for c in centre], rng.randrange(labels)))
    return rows


def test_matches_all_pairs(spark):
    rows = clustered(1, 400)
    found = got(frame(spark, rows).repartition(3))
    assert found == brute(rows) and len(found) > 100


def test_blocks_and_pieces_of_any_size_agree(spark, monkeypatch):
    rows = clustered(2, 300)
    monkeypatch.setattr(module, "BLOCK_ANCHORS", 7)
    monkeypatch.setattr(module, "ROWS", 16)
    assert got(frame(spark, rows)) == brute(rows)


def test_odd_rows(spark):
    rows = clustered(3, 60)
    nan, inf = float("nan"), float("inf")
    rows += [
        (60, None, 1), (None, [1.0] * 6, 1), (62, [1.0] * 6, None), (70, [nan] + [1.0] * 5, 1),
        (71, [inf] * 6, 2), (72, [1.0, None, 0.0, 0.0, 0.0, 0.0], 0), (73, [], 1), (80, [], 2),
        (74, [1.0, 2.0], 0), (90, [0.5] * 8, 0), (75, [0.5] * 6, 1), (76, [0.5] * 6, 1),
        (77, [0.5] * 6, 1), (100, [0.0] * 6, 0), (-50, [1.0] * 6, 0),
    ]
    assert got(frame(spark, rows)) == brute(rows)


def test_ties_and_one_label(spark):
    same = [(i, [1.0, 0.0], 1) for i in range(40)]
    assert got(frame(spark, same)) == []
    split = [(i, [1.0, 0.0] if i % 2 else [0.8, 0.0], i % 2) for i in range(40)]
    assert got(frame(spark, split)) == brute(split)


def test_repeated_rows_are_rows_of_their_own(spark):
    rows = clustered(4, 50)
    assert got(frame(spark, rows + rows[:7])) == brute(rows + rows[:7])


def test_large_numbers_stay_exact(spark):
    rng = random.Random(5)
    rows = [(i, [float(rng.randrange(2**22)) for _ in range(3)], i % 2) for i in range(60)]
    assert got(frame(spark, rows)) == brute(rows)
    # beyond 64 bits: held at the bounds, and no failure
    huge = [(i, [1e30, 1.0, float(i)], i % 2) for i in range(20)]
    assert all(r[4] == 2**63 - 1 for r in got(frame(spark, huge)))


def test_empty_table(spark):
    assert got(frame(spark, [])) == []
    assert got(frame(spark, [(1, [1.0], 1)])) == []


def test_relabelled(spark):
    rows = frame(spark, [(7, [1.0], 9), (8, [1.0], 9), (14, [1.0], None), (None, [1.0], 3)])
    assert [r.label for r in relabelled(rows).collect()] == [0, 9, None, 3]


def test_spanning_tree_is_minimal():
    rng = np.random.default_rng(6)
    vectors = np.floor(rng.standard_normal((40, 5)) * 100)
    order, parents, edges = spanning_tree(vectors)
    assert sorted(order.tolist()) == list(range(40)) and (parents < np.arange(40)).all()
    placed = vectors[order]
    for t in range(1, 40):
        assert edges[t] == pytest.approx(np.linalg.norm(placed[t] - placed[parents[t]]))
    # Kruskal
    pairs = sorted(
        (float(np.linalg.norm(vectors[i] - vectors[j])), i, j) for i in range(40) for j in range(i)
    )
    group, total = list(range(40)), 0.0
    for length, i, j in pairs:
        if group[i] != group[j]:
            total += length
            group = [group[j] if g == group[i] else g for g in group]
    assert edges.sum() == pytest.approx(total)


def test_near_anchors_need_few_scores(spark):
    """Where anchors are near each other, bounds leave most rows unscored."""
    rng = np.random.default_rng(7)
    rows = module.Rows(
        np.arange(3000), rng.integers(0, 2, 3000), np.floor(rng.standard_normal((3000, 16)) * 100), None
    )
    rows = rows._replace(norms=np.linalg.norm(rows.vectors, axis=1))
    anchors = np.floor(rows.vectors[0] + rng.standard_normal((50, 16)))
    order, parents, edges = spanning_tree(anchors)
    own = module.Rows(np.arange(50), np.zeros(50, np.int64), anchors[order], np.linalg.norm(anchors[order], axis=1))
    walk = module._Walk(module.AnchorBlock(own, parents, edges), rows)
    scored = 0
    for t in range(50):
        low, high = walk.enter(t)
        exact = rows.vectors @ own.vectors[t]
        assert (low <= exact).all() and (exact <= high).all()
        wanted = high >= np.sort(exact)[-5]
        scored += int((wanted & (low != high)).sum())
        walk.rescore(t, low, high, wanted)
        walk.leave(t, low, high)
    assert scored < 0.2 * 50 * 3000 and not walk.bounds


def test_whole_vectors():
    import pyarrow as pa

    column = pa.array([[0.5, -0.001], None, [1.0], [None, 1.0], []], pa.list_(pa.float64()))
    vectors, usable = whole_vectors(column.slice(0), 256)
    assert usable.tolist() == [True, False, True, False, True]
    assert vectors.tolist() == [[128, -1], [0, 0], [256, 0], [0, 0], [0, 0]]
