from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from orderloom.llm import collocations as module
from orderloom.llm.collocations import collocations, multikey_quicksort, pack, unpack

FIELDS = "doc_id long, text string, lang string, n long, phrase string, hash string, rank int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, 5, "clash", "clash", 1) for i, (t, lang) in enumerate(rows)], FIELDS)


def brute(rows, least=100, first=2000, percent=100):
    counts, sizes = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            ws = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(ws)
            own = counts.setdefault(lang, Counter())
            for k in range(1, 6):
                own.update(tuple(ws[i : i + k]) for i in range(len(ws) - k + 1))
    out = []
    for lang, own in counts.items():
        longer = [(p, f) for p, f in own.items() if len(p) > 2 and f >= least]
        held = Counter()
        for p, f in longer:
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    held[p[i : i + k]] = max(held[p[i : i + k]], f)
        found = []
        for p, a in own.items():
            if len(p) < 2 or a < least or (held[p] and 100 * held[p] >= percent * a):
                continue
            cuts = []
            for k in range(1, len(p)):
                l, r = own[p[:k]], own[p[k:]]
                cuts.append((1000 * a * sizes[lang] // (l * r), k, l, r))
            score, _, l, r = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (s, a, phrase, l, r) in enumerate(sorted(found)[:first], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, sizes[lang], -s))
    return sorted(out)


def got(df, **parameters):
    return sorted(tuple(r) for r in collocations(df, **parameters).collect())


def corpus(seed, n, vocabulary=40):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)]
    rows = []
    for _ in range(n):
        text = ""
        for _ in range(rng.randint(0, 30)):
            text += rng.choices(words, [1 / (i + 1) for i in range(vocabulary)])[0]
            text += rng.choice([" ", " ", " ", "  ", "\t", ". ", "\n", "? no", " New York City ", "-"])
        rows.append((text, rng.choice(["en", "en", "de", None])))
    return rows


@pytest.mark.parametrize("least,first,percent", [(3, 2000, 100), (10, 20, 100), (5, 2000, 60)])
def test_matches_brute_force(spark, least, first, percent):
    rows = corpus(least, 300)
    found = got(frame(spark, rows).repartition(4), least=least, first=first, inside_percent=percent)
    assert found == brute(rows, least, first, percent) and len(found) > 20


def test_small_chunks_blocks_and_crowded_beginnings(spark, monkeypatch):
    """Partial counts of short phrases, parts of long texts and many chunks add up."""
    rows = corpus(1, 200) + [("the end of the day " * 3000, "en"), ("x" * 30_000 + " y z. " * 200, "de")]
    monkeypatch.setattr(module, "CHUNK", 50)
    monkeypatch.setattr(module, "WIDE", 1 << 40)  # every beginning that occurs is crowded
    monkeypatch.setattr(module, "BUCKET", 100)
    parts = module._parts
    monkeypatch.setattr(module, "_parts", lambda data, offs: parts(data, offs, 500))
    blocks = module._blocks
    monkeypatch.setattr(module, "_blocks", lambda column: blocks(column, 700))
    assert got(frame(spark, rows), least=4) == brute(rows, 4)


def test_odd_rows(spark):
    rows = [
        (None, "en"), ("", "en"), (" \t ", "en"), ("...", "en"), ("one", None), ("a b", "und"), ("a b", None),
        ("É é ß É é", "fr"), ("A B a b A b", ""), ("\x1c q \x1c q", "en"), ("nul\x00 x nul\x00 x", "en"),
        ("a b c a b c a b c", "en"), ("\x0ba b\x0ca b\ra b\r\na b", "en"), ("漢字 仮名 漢字 仮名", "ja"),
    ]
    assert got(frame(spark, rows), least=2) == brute(rows, 2)
    assert got(frame(spark, rows + rows), least=2) == brute(rows + rows, 2)
    assert got(frame(spark, rows), least=100) == []
    assert got(frame(spark, [])) == []


def test_a_text_over_a_megabyte(spark):
    rng = random.Random(3)
    words = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta"]
    text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", ", "]) for _ in range(700_000))
    assert len(text) > 4 << 20
    assert got(frame(spark, [(text, "en")])) == brute([(text, "en")])


def test_products_past_64_bits(spark):
    """Scores of counts so large that their product needs more than 64 bits."""
    big = 4_000_000_000
    words = spark.createDataFrame(
        [(1, "en", "a", big), (2, "en", "b", 3 * big + 7), (3, "en", "c", 10**15)],
        "hash long, lang string, word string, n long",
    )
    phrases = spark.createDataFrame([([1, 2], big - 1)], "ws array<long>, a long")
    row = module._scored(words, phrases, phrases, 100).first()
    n = big + 3 * big + 7 + 10**15
    assert (row.n, row.score) == (n, 1000 * (big - 1) * n // (big * (3 * big + 7)))

@pytest.mark.parametrize("whole_from", [2, 3, 5])
def test_quicksort_counts(whole_from):
    rng = np.random.default_rng(whole_from)
    suffix = rng.integers(1, 6, (4000, 5)).astype(np.int32)
    lengths = rng.integers(2, 6, 4000)
    suffix[np.arange(5) >= lengths[:, None]] = 0
    suffix, weight = module._collapsed(suffix)
    want = Counter()
    for row, w in zip(suffix.tolist(), weight.tolist()):
        row = [x for x in row if x]
        for k in range(2, len(row) + 1):
            want[tuple(row[:k])] += w
    least = 20
    found = Counter()
    for length, example, total in multikey_quicksort(suffix, weight, least, whole_from):
        for e, t in zip(example.tolist(), total.tolist()):
            key = tuple(suffix[e, :length].tolist())
            assert key not in found
            found[key] = t
    assert found == {p: c for p, c in want.items() if c >= least or len(p) < whole_from}
    assert list(multikey_quicksort(suffix[:0], weight[:0], 1, 2)) == []


@pytest.mark.parametrize("common", [0, 3, 9])
def test_packing(common):
    rng = np.random.default_rng(1)
    words = rng.integers(1, 2**63, 9, dtype=np.uint64)
    matrix = words[rng.integers(0, 9, (50, 5))]
    matrix[10:20, 3:] = 0
    weight, routed = rng.integers(1, 2**40, 50), rng.integers(2, 6, 50)
    numbers = module.Codes(words[:common])
    codes, known = numbers.of(matrix)
    got_, rest, weights, routes = unpack(pack(matrix, codes, known, weight, routed))
    hashes = {0: 0} | {k + 1: w for k, w in enumerate(words[:common].tolist())}
    hashes |= {module.COMMON + 1 + k: w for k, w in enumerate(rest.tolist())}
    assert [[hashes[c] for c in row] for row in got_.tolist()] == matrix.tolist()
    assert (weights == weight).all() and (routes == routed).all()


def test_words_beyond_the_common_ones(spark, monkeypatch):
    monkeypatch.setattr(module, "COMMON", 5)
    rows = corpus(9, 300)
    assert got(frame(spark, rows), least=4) == brute(rows, 4)
