from __future__ import annotations

import hashlib
import os
import zlib
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from shared import edited, groups, prose, words
from test_sharding_mixing import poisson
from twins import compare, connect

from orderloom.llm import tokens
from orderloom.llm.registered import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def corpus() -> tuple[list[tuple], list[str]]:
    bench = [prose(900 + i, 25) for i in range(4)]
    rows = [(i, prose(i, 60 + i % 40), f"s{i % 3}") for i in range(60)]
    rows += [(100 + i, prose(i, 60 + i % 40), f"s{i % 2}") for i in range(10)]  # copies
    rows += [(200 + i, edited(prose(40, 100), 50 + i, i % 8), "s0") for i in range(20)]
    rows += [(300 + i, prose(600 + i, 70) + " " + bench[i % 4], "s1") for i in range(8)]
    rows += [(400 + i, "too short", "s2") for i in range(5)]
    rows += [(410, None, "s1"), (411, "", None), (412, "again and again " * 60, "s0")]
    return rows, bench


def test_stages_match_brute_force(spark, tmp_path):
    rows, bench = corpus()
    full = [(i, t, "en", s, len(t or "")) for i, t, s in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(full, schema)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    items = spark.createDataFrame(list(enumerate(bench)), "item_id long, text string")
    items.write.parquet(str(tmp_path / "benchmark.parquet"))

    def failed(text):
        own = words(text)
        grams = Counter(zip(own, own[1:], own[2:]))
        hit = {i + k for i, g in enumerate(zip(own, own[1:], own[2:])) if grams[g] > 1 for k in range(3)}
        return len(own) < 50 or 100 * len(hit) > 50 * len(own)

    stays = [[r for r in rows if not failed(r[1])]]
    of = groups([t for _, t, _ in stays[0]], 5, 80)
    stays.append([r for i, r in enumerate(stays[0]) if of[i] == i])  # ids rise in the list
    stays.append([r for r in stays[1] if not any(b in r[1] for b in bench)])
    sizes = Counter(s for _, _, s in stays[2])
    copies = []
    for doc_id, text, source in stays[2]:
        rate = len(stays[2]) / len(sizes) / sizes[source]
        h = int(hashlib.md5(f"17:{doc_id}:1".encode()).hexdigest()[:13], 16)
        copies += [(doc_id, text, source)] * poisson((h + 0.5) / 2**52, rate)
    stays.append(copies)

    sf_dir, now = str(tmp_path), docs
    for (_, step), want in zip(corpus_pipeline.STAGES[:4], stays):
        now = step(spark, now, sf_dir)
        assert now.columns == docs.columns
        now = spark.createDataFrame(now.collect(), schema)
        assert Counter((r.doc_id, r.text, r.source) for r in now.collect()) == Counter(want)
    assert len(rows) > len(stays[0]) > len(stays[1]) > len(stays[2]) > 40

    library = tokens.load_tokenizer(tokens.vocabulary_path("word_bpe_49k.json"))
    start, want = 0, []
    for doc_id, text, _ in sorted(copies):
        ids = np.array(library.encode(text, add_special_tokens=False).ids + [1], "<u4")
        want.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted(tuple(r) for r in got) == want


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_twins(spark, name):
    assert compare(spark, connect(SF), name, SF) == []


def test_every_operator_has_its_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES if name.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in QUERIES
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5
