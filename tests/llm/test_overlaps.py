from __future__ import annotations

import itertools
import random
import re

import numpy as np
from shared import frame, prose

from orderloom.llm.decontamination import Overlap, contaminated_documents, overlap_stretch, widest_stretch


def least(rule: Overlap, n: int) -> int:
    return min(rule.min_words, -(-4 * n // 5))


def has_seed(pattern: str, masks: tuple[str, ...]) -> bool:
    return any(
        all(pattern[at + k] == "1" for k, c in enumerate(mask) if c == "1")
        for mask in masks
        for at in range(len(pattern) - len(mask) + 1)
    )


def seedless(rule: Overlap, masks: tuple[str, ...]) -> str | None:
    """A stretch of any length with min_words agreeing words, percent of all, and no seed.

    States are the last words and the number of agreeing ones up to min_words, each with
    the best score so far; a stretch whose score sinks below -min_words has an overlap
    behind the place where it does, or none.
    """
    width = max(map(len, masks))
    gain, loss, best = 100 - rule.percent, rule.percent, {}
    now = {("", 0): (0, "")}
    while now:
        found = {}
        for (tail, n), (score, pattern) in now.items():
            for c in "01":
                last = (tail + c)[-width:]
                if any(has_seed(last[-len(m) :], (m,)) for m in masks):
                    continue
                total = score + (gain if c == "1" else -loss)
                state = last[1 - width :], min(rule.min_words, n + int(c))
                if total < -gain * rule.min_words or best.get(state, total - 1) >= total:
                    continue
                if state[1] == rule.min_words and total >= 0:
                    return pattern + c
                best[state] = total
                found[state] = total, pattern + c
        now = found
    return None


def test_every_overlap_has_a_seed():
    rule = Overlap()
    assert seedless(rule, ("1101100101", "1010011011", "1110100011", "1011101001"))
    assert seedless(rule, rule.masks) is None
    for n in range(rule.least_item, 17):  # the longest item of which fewer than all count
        masks = rule.masks if n >= rule.full_item else rule.light
        for same in itertools.combinations(range(n), least(rule, n)):
            assert has_seed("".join("01"[k in same] for k in range(n)), masks), (n, same)


def test_passages_with_replaced_words_are_found(spark):
    """Every fifth word in all phases, and short items with all the words replaced that may be."""
    rng, texts, rows, want = random.Random(8), [], [], set()
    for n in [*range(5, 18), 40]:
        item = len(texts)
        texts.append(" ".join(f"w{item}x{k}" for k in range(n)))
        replaced = [set(range(phase, n, 5)) for phase in range(5)] if n % 5 == 0 else []
        replaced += [set(rng.sample(range(n), n - least(Overlap(), n))) for _ in range(8)] if n < 18 else []
        for gone in replaced:
            own = ["other" if k in gone else w for k, w in enumerate(texts[-1].split())]
            want.add((len(rows), item))
            rows.append((len(rows), " ".join([prose(len(rows), 9), *own, prose(7, 9)]), "s"))
    bench = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    got = contaminated_documents(frame(spark, rows), bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want


def accepted(same, least: int, percent: int) -> bool:
    """Whether any stretch has the words and the share."""
    stretches = itertools.combinations(range(len(same) + 1), 2)
    counts = ((int(same[a:b].sum()), b - a) for a, b in stretches)
    return any(n >= least and 100 * n >= percent * size for n, size in counts)


def test_widest_stretch_by_all_stretches():
    rng, late = random.Random(6), 0
    for _ in range(600):
        same = np.array([rng.random() < 0.7 for _ in range(rng.randrange(0, 28))], bool)
        start, end = widest_stretch(same, 75)
        inside = [
            int(same[a:b].sum())
            for a, b in itertools.combinations(range(len(same) + 1), 2)
            if 100 * same[a:b].sum() >= 75 * (b - a)
        ]
        assert same[start:end].sum() == max(inside, default=0)
        assert 100 * same[start:end].sum() >= 75 * (end - start)
        found = overlap_stretch(same, 13, 75)
        assert (found is not None) == accepted(same, 13, 75)
        late += found == (start, end)
        if found:
            a, b = found
            assert same[a:b].sum() >= 13 and 100 * same[a:b].sum() >= 75 * (b - a)
    assert late


def test_passages_that_fall_apart_match_all_stretches(spark):
    """All diagonals and all stretches of each pair; pairs need not share a seed."""
    runs = [(8, 3, 8), (12, 4, 12), (8, 4, 8), (12, 8, 12), (9, 3, 3, 1, 3), (6, 3, 6), (6, 4, 6)]
    texts, docs = [], []
    for i, lengths in enumerate(runs):
        own = [f"v{i}x{k}" for k in range(sum(lengths))]
        texts.append(" ".join(own))
        at = 0
        for j, n in enumerate(lengths):
            if j % 2:
                own[at : at + n] = ["other"] * n
            at += n
        docs.append(f"{prose(600 + i, 12)} {' '.join(own)} {prose(700 + i, 5)}")
    rule, want = Overlap(), set()
    for (d, doc), (i, item) in itertools.product(enumerate(docs), enumerate(texts)):
        a, b = re.findall(r"[^\W_]+", doc.lower()), item.split()
        for diagonal in range(1 - len(b), len(a)):
            lo, hi = max(0, -diagonal), min(len(b), len(a) - diagonal)
            same = np.array([a[k + diagonal] == b[k] for k in range(lo, hi)], bool)
            if accepted(same, least(rule, len(b)), rule.percent):
                want.add((d, i))
    assert {(0, 0), (1, 1)} <= want and len(want) < len(runs)
    bench = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    got = contaminated_documents(frame(spark, [(d, t, "s") for d, t in enumerate(docs)]), bench)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want
