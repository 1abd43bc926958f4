from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F
from shared import frame, odd_rows

from orderloom.llm.mixing import mix_sources, poisson_count
from orderloom.llm.sharding import assign, shard_documents


def best_shard(key: str, weights: list[float], seed: int = 0) -> int:
    best = None
    for shard, weight in enumerate(weights):
        h = xxhash.xxh64(f"{seed}:{shard}:{key}".encode(), seed=42).intdigest() >> 11
        score = (math.log((h + 0.5) / 2**53) / weight, -shard)
        best = max(best, score) if best else score
    return -best[1]


def test_shards_match_brute_force(spark):
    rows = odd_rows()
    got = shard_documents(frame(spark, rows), shards=5).collect()
    assert len(got) == len(rows)
    want = Counter()
    for doc_id, text, _ in rows:
        key = "null" if doc_id is None else f"k{doc_id}"
        raw = (text or "").encode()
        want[
            doc_id, len(raw) + 16, zlib.crc32(raw), best_shard(key, [1] * 5), best_shard(key, [1] * 6)
        ] += 1
    assert want == Counter(
        (r.doc_id, r["size"], r.text_crc32, r.shard, r.grown_shard) for r in got
    )
    for shard in range(5):
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))


def test_growing_moves_only_into_the_new_shard(spark):
    keys = spark.range(4000).withColumnRenamed("id", "doc_id")
    before = assign(keys, "doc_id", [1.0, 2.0, 1.0], "a")
    both = assign(before, "doc_id", [1.0, 2.0, 1.0, 1.0], "b").collect()
    moved = [r for r in both if r.a != r.b]
    assert all(r.b == 3 for r in moved) and 600 < len(moved) < 1000
    counts = Counter(r.a for r in both)
    assert 1800 < counts[1] < 2200


def test_empty_tables(spark):
    empty = frame(spark, [])
    assert shard_documents(empty).collect() == []
    assert mix_sources(empty).collect() == []


def poisson(u: float, rate: float) -> int:
    p = below = math.exp(-rate)
    k = 0
    while u > below:
        k += 1
        p *= rate / k
        below += p
    return k


@pytest.mark.parametrize("weights", [None, {"s0": 3.0, "s1": 0.5, None: 1.0}])
def test_copies_match_brute_force(spark, weights):
    rows = odd_rows()
    got = mix_sources(frame(spark, rows), weights).collect()
    sizes = Counter(s for _, _, s in rows)
    share = {s: 1.0 for s in sizes} if weights is None else weights
    total = sum(share.get(s, 0) for s in sizes)
    want = Counter()
    for doc_id, text, source in rows:
        rate = share.get(source, 0) / total * len(rows) / sizes[source]
        name = "null" if doc_id is None else str(doc_id)
        h = int(hashlib.md5(f"17:{name}:1".encode()).hexdigest()[:13], 16)
        for copy in range(poisson((h + 0.5) / 2**52, rate) if rate else 0):
            want[doc_id, text, source, copy] += 1
    assert want == Counter((r.doc_id, r.text, r.source, r._copy) for r in got)
    assert [r._order for r in got] == sorted(r._order for r in got)
    assert {r._row for r in got} <= {"clash"}


def test_taken_names_stay(spark):
    docs = frame(spark, odd_rows()).withColumn("_copy", F.lit("mine"))
    mixed = mix_sources(docs)
    assert mixed.columns == [*docs.columns, "_rate", "_order"]
    assert {r._copy for r in mixed.collect()} == {"mine"}


def test_rates_are_met_and_large_rates_work(spark):
    base = spark.range(20000).select(((F.col("id") + 0.5) / 20000).alias("u"))
    for rate in (0.3, 4.0, 300.0):
        mean = base.select(F.avg(poisson_count(F.col("u"), F.lit(rate)))).first()[0]
        assert abs(mean - rate) < 0.01 * rate + 0.01
    few = frame(spark, [(1, "a", "rare"), *[(i, "b", "often") for i in range(2, 4000)]])
    copies = mix_sources(few, {"rare": 1.0}).count()
    assert abs(copies - 3999) < 300
