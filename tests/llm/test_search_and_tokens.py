from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import regex
from shared import FIELDS, WORDS, frame, odd_rows, prose

from orderloom.llm import tokens
from orderloom.llm.decontamination import Overlap, best_stretch, clean_documents, contaminated_documents
from orderloom.scratch import new_path

BYTES = tokens.vocabulary_path("byte_bpe_50k.json")
WORD = tokens.vocabulary_path("word_bpe_49k.json")


def items(spark):
    texts = [prose(50 + i, 20 + i) for i in range(8)] + [prose(70, 7), "of the", None, ""]
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string"), texts


def planted(texts: list) -> tuple[list[tuple], set]:
    rows, want = [], set()
    for i in range(8):
        own = texts[i].split()
        middle = [w.upper() + "," for w in own]
        rows.append((i, " ".join([prose(90 + i, 40), *middle, prose(190 + i, 30)]), "s"))
        swapped = list(own)
        for k in range(4, len(own), 9):  # one word in nine replaced
            swapped[k] = "other"
        rows.append((100 + i, prose(290 + i, 20) + " " + " ".join(swapped), "s"))
        want |= {(i, i), (100 + i, i)}
    rows.append((300, texts[8] + " " + prose(400, 30), "s"))  # a short item, whole
    want.add((300, 8))
    rows += [(400 + i, prose(500 + i, 300), "s") for i in range(30)]
    rows += [(600, None, "s"), (601, "", "s"), (None, texts[0], "s"), (602, " ".join(texts[1].split()[:9]), "s")]
    want.add((None, 0))
    return rows, want


def test_passages_are_found_and_clean_documents_left_alone(spark):
    bench, texts = items(spark)
    rows, want = planted(texts)
    docs = frame(spark, rows)
    got = contaminated_documents(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == want
    assert all(r.n_same * 100 >= 75 * r.n_words for r in got)
    stay = clean_documents(docs, bench)
    bad = {i for i, _ in want}
    assert stay.columns == docs.columns
    assert Counter(r.doc_id for r in stay.collect()) == Counter(r[0] for r in rows if r[0] not in bad)


def test_overlaps_match_brute_force(spark):
    """Every diagonal of every pair, for pairs that share a seed."""
    bench, texts = items(spark)
    rows, _ = planted(texts)
    rule = Overlap()
    got = {(r.doc_id, r.item_id): r.n_same for r in contaminated_documents(frame(spark, rows), bench).collect()}

    def own(text):
        return re.findall(r"[^\W_]+", (text or "").lower())

    want = {}
    for doc_id, text, _ in rows:
        doc = own(text)
        for item_id, item_text in enumerate(texts):
            item = own(item_text)
            if len(item) < rule.least_item:
                continue
            masks = rule.offsets() if len(item) >= rule.span() else [tuple(range(len(item)))]
            for diagonal in range(1 - len(item), len(doc)):
                lo, hi = max(0, -diagonal), min(len(item), len(doc) - diagonal)
                same = np.array([doc[k + diagonal] == item[k] for k in range(lo, hi)], bool)
                seeded = any(
                    all(same[p + o] for o in m) for m in masks for p in range(len(same) - m[-1])
                )
                start, end = best_stretch(same, rule.percent)
                agree = int(same[start:end].sum())
                if seeded and agree >= min(rule.min_words, -(-4 * len(item) // 5)):
                    want[doc_id, item_id] = max(agree, want.get((doc_id, item_id), 0))
    assert got == want


def test_best_stretch_by_all_stretches():
    rng = random.Random(5)
    for _ in range(200):
        same = np.array([rng.random() < 0.6 for _ in range(rng.randrange(0, 25))], bool)
        start, end = best_stretch(same, 75)
        scores = [
            sum(25 if x else -75 for x in same[a:b])
            for a in range(len(same) + 1)
            for b in range(a, len(same) + 1)
        ]
        assert sum(25 if x else -75 for x in same[start:end]) == max(scores, default=0)


def test_empty_sides(spark):
    bench, texts = items(spark)
    rows, _ = planted(texts)
    assert contaminated_documents(frame(spark, []), bench).collect() == []
    none = bench.where("false")
    assert contaminated_documents(frame(spark, rows), none).collect() == []
    assert clean_documents(frame(spark, rows), none).count() == len(rows)


def many_texts() -> list[tuple]:
    rng = random.Random(3)
    signs = ["'s", "don't", "  ", "\n\n", "\t", "<|endoftext|>", "<|startoftext|>", "1234", "é", "ÀÉ",
             "漢字", "՘", "🙂", "á", "...", "$5.00", " ", "İ", "Σ", " ", "　"]
    rows = odd_rows()
    for i in range(60):
        parts = [rng.choice(signs + WORDS[:40]) + rng.choice(["", " ", " "]) for _ in range(80)]
        rows.append((1000 + i, "".join(parts), "s"))
    rows.append((5000, prose(7, 90_000), "s"))  # longer than a piece
    return rows


def test_counts_match_the_library(spark):
    rows = many_texts()
    library = tokens.load_tokenizer(BYTES)
    want = Counter()
    for doc_id, text, _ in rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        want[doc_id, len((text or "").encode()), n, n > 1024] += 1
    got = tokens.token_counts(frame(spark, rows), BYTES).collect()
    assert want == Counter(tuple(r) for r in got)
    assert tokens.token_counts(frame(spark, []), BYTES).collect() == []


def test_pattern_and_library_agree_on_all_stated_code_points():
    library, pattern = tokens.load_tokenizer(BYTES).pre_tokenizer, regex.compile(tokens.PRE_TOKENS)
    points = [c for c in map(chr, range(0x10000)) if regex.fullmatch(f"[{tokens.AGREED}]", c)]
    assert len(points) > 30_000
    for at in range(0, len(points), 2000):
        text = "".join(f"a{c}1{c}.{c} b" for c in points[at : at + 2000])
        assert [text[a:b] for _, (a, b) in library.pre_tokenize_str(text)] == pattern.findall(text)


def test_whole_tokens_are_one_token():
    library, found = tokens.load_tokenizer(BYTES), tokens.whole_tokens(BYTES)
    assert len(found) > 45_000 and "<|endoftext|>" not in found
    for text in random.Random(1).sample(sorted(found), 2000):
        assert len(library.encode(text, add_special_tokens=False).ids) == 1


def test_token_files_round_trip(spark):
    rows = [r for r in many_texts()]
    library, out = tokens.load_tokenizer(WORD), new_path(spark, "test-tokens")
    tokens.write_token_files(frame(spark, rows).repartition(5), out, WORD, end_id=1)
    encoded = Counter()
    for doc_id, text, _ in rows:
        encoded[doc_id, tuple(library.encode(text or "", add_special_tokens=False).ids + [1])] += 1
    assert encoded == Counter((r.doc_id, tuple(r.ids)) for r in tokens.read_token_files(spark, out).collect())
    digests = tokens.token_digests(spark, out).orderBy("start").collect()
    start = 0
    for r in digests:
        assert r.start == start
        start += r.n_tokens
    keys = [r.doc_id for r in digests]
    assert keys == sorted(keys, key=lambda k: (k is not None, k or 0))
    want = Counter(
        (k, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for k, ids in encoded.elements()
    )
    assert want == Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in digests)


@pytest.mark.parametrize("kind", ["tinyint", "smallint", "int", "bigint", "string"])
def test_token_files_order_ids_by_their_kind(spark, kind):
    ids = [10, 2, None, 9, 100]
    docs = spark.createDataFrame([(i, f"some text {i}") for i in ids], "doc_id long, text string")
    out = new_path(spark, "test-kinds")
    tokens.write_token_files(docs.withColumn("doc_id", docs.doc_id.cast(kind)), out, WORD)
    found = [r.doc_id for r in tokens.token_digests(spark, out).orderBy("start").collect()]
    texts = [None, "10", "100", "2", "9"]
    assert found == (texts if kind == "string" else [None, 2, 9, 10, 100])


def test_token_files_of_nothing(spark):
    out = new_path(spark, "test-no-tokens")
    tokens.write_token_files(spark.createDataFrame([], FIELDS), out, WORD)
    assert tokens.token_digests(spark, out).collect() == []


def test_wrong_kinds_of_vocabulary_are_refused(spark):
    docs = frame(spark, odd_rows())
    with pytest.raises(ValueError):
        tokens.token_counts(docs, WORD)
    with pytest.raises(ValueError):
        tokens.write_token_files(docs, "unused", BYTES)


def test_a_repeated_phrase_is_linear_work(spark):
    """Each diagonal carries the words beside the item, not the whole document."""
    import time

    phrase = " ".join(f"word{i}" for i in range(30))
    items = spark.createDataFrame([(1, phrase), (2, "same " * 20)], "item_id long, text string")

    def seconds(repeats):
        docs = spark.createDataFrame(
            [(1, (phrase + " ") * repeats), (2, "same " * 8 * repeats)], "doc_id long, text string"
        )
        began = time.time()
        found = {(r.doc_id, r.item_id): r.n_same for r in contaminated_documents(docs, items).collect()}
        assert found == {(1, 1): 30, (2, 2): 20}
        return time.time() - began

    seconds(10)
    short, long = seconds(2000), seconds(4000)
    assert long < 2.5 * short + 3


def test_stretches_at_the_ends_of_a_text(spark):
    phrase = [f"word{i}" for i in range(20)]
    texts = [" ".join(phrase[4:]), " ".join(phrase[:15]), "x " + " ".join(phrase[6:]), " ".join(phrase[:12])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = spark.createDataFrame([(7, " ".join(phrase))], "item_id long, text string")
    found = {r.doc_id: (r.doc_start, r.item_start, r.n_same) for r in contaminated_documents(docs, items).collect()}
    assert found == {0: (0, 4, 16), 1: (0, 0, 15), 2: (1, 6, 14)}
