"""Customer scoring: quartile and quintile scores, segments, tiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Segment names by recency score and frequency score.
SEGMENTS = [
    ("[1-2][1-2]", "Hibernating"),
    ("[1-2][3-4]", "At risk"),
    ("[1-2]5", "Can't lose them"),
    ("3[1-2]", "About to sleep"),
    ("33", "Need attention"),
    ("[3-4][4-5]", "Loyal customers"),
    ("41", "Promising"),
    ("51", "New customers"),
    ("[4-5][2-3]", "Potential loyalists"),
    ("5[4-5]", "Champions"),
]
# Tier limits on the score sum, best tier first.
TIERS_LOW_IS_BEST = [("Platinum", 5), ("Gold", 7), ("Silver", 9), ("Bronze", 12)]
TIERS_HIGH_IS_BEST = [("Platinum", 10), ("Gold", 9), ("Silver", 7), ("Bronze", 5)]
LAST_TIER = "Green"


def _ladder(cases: Sequence[tuple[Column, str]], default: str | None) -> Column:
    pick = None
    for hit, label in cases:
        pick = F.when(hit, label) if pick is None else pick.when(hit, label)
    return pick if default is None else pick.otherwise(default)


def quantile_score(value: Column, cuts: Sequence[Column], low_is_best: bool) -> Column:
    """Score 1..len(cuts)+1 by ``<=`` against rising cut points."""
    top = len(cuts) + 1
    score = None
    for i, cut in enumerate(cuts, start=1):
        points = top + 1 - i if low_is_best else i
        score = F.when(value <= cut, points) if score is None else score.when(value <= cut, points)
    return score.otherwise(1 if low_is_best else top)


def score_text(*scores: Column) -> Column:
    return F.concat(*[score.cast("string") for score in scores])


def segment_name(recency_score: Column, frequency_score: Column) -> Column:
    pair = score_text(recency_score, frequency_score)
    return _ladder([(pair.rlike(f"^{pat}$"), name) for pat, name in SEGMENTS], None)


def tier_low_is_best(total: Column) -> Column:
    return _ladder([(total < limit, name) for name, limit in TIERS_LOW_IS_BEST], LAST_TIER)


def tier_high_is_best(total: Column) -> Column:
    return _ladder([(total > limit, name) for name, limit in TIERS_HIGH_IS_BEST], LAST_TIER)
