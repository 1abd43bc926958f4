from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from shared import edited, folded, frame, groups, odd_rows, prose, shingle_set, words

from orderloom.llm.components import components
from orderloom.llm import ngram_join
from orderloom.llm.ngram_join import (
    Threshold,
    _within,
    near_duplicate_components,
    odd_blocks,
    one_of_each_group,
)
from orderloom.llm.quality_rules import HostRules, host_rates, judge_documents, keep_documents, text_measures


def measures(text: str | None) -> tuple:
    own = words(text)
    grams = Counter(zip(own, own[1:], own[2:]))
    covered = set()
    for i, gram in enumerate(zip(own, own[1:], own[2:])):
        if grams[gram] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if words(x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(own), sum(map(len, own)), symbols, len(lines) - len(set(lines)), len(covered)


def test_measures_match_brute_force(spark):
    rows = odd_rows()
    got = judge_documents(frame(spark, rows)).collect()
    want = Counter()
    for doc_id, text, _ in rows:
        m = measures(text)
        failed = m[0] < 50 or 100 * m[4] > 50 * m[0]
        want[(doc_id, *m, failed)] += 1
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert want == Counter((r.doc_id, *[r[n] for n in names]) for r in got)


def test_small_hosts_are_shrunk(spark):
    good, bad = prose(1, 80), "too short"
    rng = random.Random(3)
    rows = [(i, bad if rng.random() < 0.1 + i % 5 / 20 else good, f"h{i % 5}") for i in range(500)]
    rows += [(2000, bad, "tiny")]
    counts = Counter(s for _, _, s in rows)
    fails = Counter(s for _, t, s in rows if t == bad)
    n, f = sum(counts.values()), sum(fails.values())
    m = f / n
    v = sum(fails[s] ** 2 / counts[s] for s in counts) / n - m * m
    strength = m * (1 - m) / (v - m * (1 - m) * len(counts) / n) - 1
    want = {s: (fails[s] + strength * m) / (counts[s] + strength) for s in counts}
    docs = frame(spark, rows)
    rates = {r._host: r.base_rate for r in host_rates(text_measures(docs), "source").collect()}
    assert rates == pytest.approx(want)
    assert rates["tiny"] < 0.5  # one document does not condemn a host


def test_bad_hosts_are_rejected(spark):
    good, bad = prose(1, 80), "too short"
    rows = [(i, good, f"h{i % 10}") for i in range(200)]
    rows += [(1000 + i, bad if i % 10 else good, "spam") for i in range(100)]
    docs = frame(spark, rows)
    kept = {r.doc_id for r in judge_documents(docs).collect() if r.kept}
    assert kept == set(range(200))
    stay = keep_documents(docs)
    assert stay.columns == docs.columns and {r.doc_id for r in stay.collect()} == kept
    lenient = keep_documents(docs, rules=HostRules(host_limit=0.99))
    assert lenient.count() == 210


def test_empty_tables(spark):
    empty = frame(spark, [])
    for result in (judge_documents(empty), keep_documents(empty)):
        assert result.collect() == []
    assert near_duplicate_components(empty).collect() == []
    assert one_of_each_group(empty).collect() == []


def near_copy_rows() -> list[tuple]:
    """A group of near copies around a base, groups with a shared passage, and chains."""
    base, passage = prose(21, 150), prose(22, 90)
    rows = [(i, edited(base, 100 + i, i % 13), "s") for i in range(120)]
    rows += [(200 + i, passage + " " + prose(300 + i, 12 + i % 30), "s") for i in range(60)]
    text = prose(23, 120)
    for i in range(25):  # each step changes a little, the ends share little
        rows.append((300 + i, text, "s"))
        text = edited(text, 400 + i, 2)
    rows += [(400 + i, " ".join(prose(24, 100).split()[i:]), "s") for i in range(0, 30, 3)]
    return rows


@pytest.mark.parametrize("rows", [odd_rows(), near_copy_rows()], ids=["odd", "near"])
def test_components_match_all_pairs(spark, rows):
    got = Counter(near_duplicate_components(frame(spark, rows)).collect())
    texts = [t for _, t, _ in rows]
    of = groups(texts, 4, 85)
    want = Counter()
    for i, (doc_id, text, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if of[j] == of[i] and rows[j][0] is not None]
        alone = not shingle_set(text, 4)
        least = doc_id if alone else min(ids, default=None)
        want[doc_id, len(shingle_set(text, 4)), least] += 1
    assert want == Counter(tuple(r) for r in got.elements())


def test_one_of_each_group_stays(spark):
    rows = odd_rows() + [(500 + i, t, s) for i, t, s in near_copy_rows()]
    docs = frame(spark, rows)
    got = one_of_each_group(docs)
    assert got.columns == docs.columns
    of = groups([t for _, t, _ in rows], 5, 80)
    want = Counter()
    for root in set(of):
        members = [rows[i] for i in range(len(rows)) if of[i] == root]
        want[min(members, key=lambda r: (r[0] is None, r[0] or 0))[:2]] += 1
    assert want == Counter((r.doc_id, r.text) for r in got.collect())


def test_threshold_is_exact(spark):
    # 4-word sets of 23 and 27 shingles: 23 / 27 = 0.8518..., one more word gives 23 / 28
    own = prose(31, 30).split()
    for length, linked in ((30, True), (31, False)):
        longer = (own + ["y1", "y2"])[:length]
        rows = [(1, " ".join(own[:26]), "s"), (2, " ".join(longer), "s")]
        found = {r.component_id for r in near_duplicate_components(frame(spark, rows)).collect()}
        assert (len(found) == 1) is linked


def test_components_of_a_long_path(spark):
    pairs = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (101, 101)]
    got = components(spark.createDataFrame(pairs, "a long, b long"), "a", "b").collect()
    assert {tuple(r) for r in got} == {(i, 0) for i in range(61)} | {(100, 100), (101, 100)}


def test_bounds_never_exclude_a_link():
    import numpy as np

    for percent in (80, 85):
        rule = Threshold(percent)
        n = np.arange(1, 400)
        lead = rule.lead_length(n)
        assert ((lead >= 1) & (lead <= n)).all()
        assert (100 * (n - lead) < percent * n).all()


def test_odd_blocks_never_exclude_a_link(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    rule = Threshold()
    sets, pairs = [], []
    for n in (1, 2, 5, 63, 64, 65, 120, 128, 140, 500, 2000):
        base = rng.integers(0, 2**63, n, dtype=np.uint64)
        for m in range(4):
            extra = rng.integers(0, 2**63, n * m // 12, dtype=np.uint64)
            pairs.append((len(sets), len(sets) + 1))
            sets += [base, np.concatenate([base[len(extra) // 2 :], extra])]
    far = len(sets)
    sets += [rng.integers(0, 2**63, 500, dtype=np.uint64) for _ in range(2)]
    pairs.append((far, far + 1))
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    words, ends = odd_blocks(np.concatenate(sets), owner, np.array([len(x) for x in sets]))
    odd = [(i, words[ends[i] : ends[i + 1]].tolist()) for i in range(len(sets))]
    rows = [(a, b, len(sets[a]), len(sets[b])) for a, b in pairs]
    got = _within(
        spark.createDataFrame(rows, "a long, b long, na long, nb long"),
        spark.createDataFrame(odd, "_row long, odd array<long>"),
        rule,
    ).collect()
    kept = {(r.a, r.b) for r in got}
    links = {
        (a, b)
        for a, b in pairs
        if 100 * len(np.intersect1d(sets[a], sets[b])) >= 85 * len(np.union1d(sets[a], sets[b]))
    }
    assert links and links <= kept and (far, far + 1) not in kept


def test_columns_of_frequent_cells(spark, monkeypatch):
    # every column counts as frequent: none is looked up, and the components are the same
    rows = near_copy_rows()
    want = sorted(near_duplicate_components(frame(spark, rows)).collect())
    monkeypatch.setattr(ngram_join, "WIDE", 1)
    assert sorted(near_duplicate_components(frame(spark, rows)).collect()) == want
    levels = ngram_join.column_levels
    monkeypatch.setattr(ngram_join, "column_levels", lambda *a: (levels(*a)[0], 0))
    assert sorted(near_duplicate_components(frame(spark, rows)).collect()) == want


def test_texts_above_a_block(spark):
    # 1.2 and 2.4 MB: hashed in pieces, equal to a set of the whole text
    long = prose(41, 220_000)
    rows = [(1, long, "s"), (2, edited(long, 42, 900), "s"), (3, long + " " + prose(43, 220_000), "s")]
    sizes = {i: len(shingle_set(t, 4)) for i, t, _ in rows}
    one, two = (shingle_set(rows[i][1], 4) for i in (0, 1))
    linked = 100 * len(one & two) >= 85 * len(one | two)
    assert len(long) > 1 << 20 and linked
    found = near_duplicate_components(frame(spark, rows)).collect()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in found}
    assert got == {1: (sizes[1], 1), 2: (sizes[2], 1), 3: (sizes[3], 3)}


def test_folding_is_ascii_only():
    assert folded("ÀB") == "Àb"
