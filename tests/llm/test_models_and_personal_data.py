from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from shared import frame, odd_rows, prose

from orderloom.llm import importance, personal_data, toxicity
from orderloom.llm.personal_data import KINDS, passes_luhn, private_documents


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str | None) -> list[tuple]:
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


def private_rows() -> list[tuple]:
    rng = random.Random(9)
    pieces = ["4111111111111111", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (974) 555-3436",
              "+44 20 7946 0958", "+1234", "10.0.0.1", "256.1.1.1", "1.2.3.4.5.6.7.8", "001.002.03.4",
              "a@b.co", "x.y+z@mail.example.com", "a@b.c_d@e.f", "@x.y", "no@dot", "a@@b.c", "é@b.co",
              "🙂 a.b@c.de", "5 5", "12", "7-7-7", "1 4111111111111111", "me [at] here [dot] org",
              "+1 (826) 555-4081 190.137.223.204", "..a@b.c.", "9" * 25, "a@b.co.c@d.ef"]
    rows = odd_rows()
    for i in range(150):
        parts = [rng.choice(pieces + ["word", "tel", "ip:", "."]) for _ in range(rng.randrange(1, 12))]
        rows.append((1000 + i, rng.choice([" ", "  ", ", ", ""]).join(parts), "s"))
    rows.append((9000, "z" * 50_000 + "@" + "1" * 50_000, "s"))
    return rows


def test_base_spans_match_brute_force_and_stay(spark):
    rows = private_rows()
    # a card beside another number: the base match takes both and fails
    rows.append((9100, "pay 7536784127813050 4111111111111111 now", "s"))
    got = private_documents(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    beside = next(r for r in got if r.doc_id == 9100)
    assert beside.n_card == 0 and "card:21:37" in beside.spans
    want = Counter()
    for doc_id, text, _ in rows:
        spans = base_spans(text)
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        kinds = Counter(k for k, _, _ in spans)
        want[(doc_id, *[kinds[k] for k in KINDS], hashlib.sha256(joined.encode()).hexdigest())] += 1
    assert want == Counter((r.doc_id, *[r[f"n_{k}"] for k in KINDS], r.base_sha256) for r in got)
    texts = {r[0]: r[1] for r in rows if r[0] is not None and r[0] >= 1000}
    added = 0
    for r in got:
        if r.doc_id in texts:
            base = {f"{k}:{a}:{b}" for k, a, b in base_spans(texts[r.doc_id])}
            own = r.spans.split(",") if r.spans else []
            assert base <= set(own)
            assert own == sorted(own, key=lambda s: (KINDS.index(s.split(":")[0]), int(s.split(":")[1])))
            added += len(set(own) - base)
    assert added > 0


def test_no_personal_data_and_no_rows(spark):
    plain = [(i, prose(i, 30), "s") for i in range(5)] + [(9, None, None)]
    got = private_documents(frame(spark, plain)).collect()
    assert {r.spans for r in got} == {""} and len(got) == 6
    assert private_documents(frame(spark, [])).collect() == []


def test_luhn(spark):
    values = ["4111111111111111", "4111111111111112", "12", "", "0" * 13, "1" * 20]
    df = spark.createDataFrame([(v,) for v in values], "d string")
    assert [r[0] for r in df.select(passes_luhn(df.d)).collect()] == [True, False, False, False, True, False]


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, toxic int, quality int, text string")


TOXIC = ["vile", "scum", "idiot", "trash", "moron"]


def toxic_rows() -> tuple[list[tuple], list[tuple]]:
    rng, docs, labels = random.Random(4), [], []
    for i in range(900):
        words = prose(i, rng.randrange(30, 120)).split()
        toxic = i % 5 == 0
        if toxic:
            for _ in range(rng.randrange(2, 5)):
                words.insert(rng.randrange(len(words)), rng.choice(TOXIC))
        docs.append((i, " ".join(words).title() if i % 3 else " ".join(words), "s"))
        labels.append((i, int(toxic), 1, "clash"))
    return docs, labels


def test_toxicity_on_held_out_rows(spark):
    docs, labels = toxic_rows()
    table = frame(spark, docs + [(5000, None, "s"), (None, "", "s"), (1, docs[1][1], "s")])
    extra = [(None, 1, 1, ""), (5, None, 1, ""), (99999, 1, 1, ""), (0, 0, 0, "")]
    got = toxicity.toxic_documents(table, labelled(spark, labels + extra)).collect()
    assert len(got) == len(docs) + 3
    truth = {i: t for i, t, _, _ in labels}
    held = [r for r in got if r.held_out]
    assert all((zlib.crc32(str(r.doc_id).encode()) % 3 == 1) == r.held_out for r in got if r.doc_id is not None)
    hits = [r for r in held if truth.get(r.doc_id)]
    assert sum(r.predicted for r in hits) >= 0.9 * len(hits) > 20
    clean = [r for r in held if not truth.get(r.doc_id)]
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got)


def test_held_out_labels_are_not_learned(spark):
    docs, labels = toxic_rows()
    flipped = [(i, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t, q, x) for i, t, q, x in labels]
    table = frame(spark, docs)
    a = {r.doc_id: r.score for r in toxicity.toxic_documents(table, labelled(spark, labels)).collect()}
    b = {r.doc_id: r.score for r in toxicity.toxic_documents(table, labelled(spark, flipped)).collect()}
    assert a == b


def test_ftrl_against_plain_loops():
    rng = random.Random(2)
    examples = [
        (np.array(sorted(rng.sample(range(20), 5)), np.int64), rng.randrange(2)) for _ in range(60)
    ]
    rule = toxicity.Ftrl(alpha=0.5, beta=1.0, l1=0.2, l2=0.1, epochs=2, toxic_weight=2.0)
    z, n, bias, bias_n = [0.0] * 20, [0.0] * 20, 0.0, 0.0

    def weight(i):
        if abs(z[i]) <= rule.l1:
            return 0.0
        sign = 1 if z[i] > 0 else -1
        return -(z[i] - sign * rule.l1) / ((rule.beta + n[i] ** 0.5) / rule.alpha + rule.l2)

    for _ in range(rule.epochs):
        for at, label in examples:
            w = {i: weight(i) for i in at}
            p = 1 / (1 + np.exp(-(sum(w.values()) + bias)))
            g = (p - label) * (2.0 if label else 1.0)
            for i in at:
                sigma = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / rule.alpha
                z[i] += g - sigma * w[i]
                n[i] += g * g
            bias_n += g * g
            bias -= rule.alpha * g / (rule.beta + bias_n**0.5)
    model = toxicity.fit(examples, rule)
    assert model.bias == pytest.approx(bias)
    assert model.dense()[:20] == pytest.approx([weight(i) for i in range(20)])


def test_models_without_labels_or_documents(spark):
    docs, labels = toxic_rows()
    none = labelled(spark, [])
    got = toxicity.toxic_documents(frame(spark, docs[:20]), none).collect()
    assert {r.score for r in got} == {0.5} and {r.predicted for r in got} == {0}
    assert toxicity.toxic_documents(frame(spark, []), labelled(spark, labels)).collect() == []
    kept = importance.resample(frame(spark, docs[:20]), none).collect()
    assert len(kept) == 20 and all(r.kept for r in kept)
    assert importance.resample(frame(spark, []), labelled(spark, labels)).collect() == []


def test_resampling_prefers_the_target(spark):
    rng, docs, labels = random.Random(6), [], []
    for i in range(600):
        good = i % 4 != 0
        text = prose(i, 60) if good else " ".join(rng.choice("!!! ### BUY NOW $$$".split()) for _ in range(60))
        docs.append((i, text, "s"))
        if i < 300:
            labels.append((i, 0, int(good), "clash"))
    odd = [(5000, None, None), (None, prose(1, 60), "s"), (1, docs[1][1], "s")]
    table = frame(spark, docs + odd)
    got = importance.resample(table, labelled(spark, labels)).collect()
    k = round(len(got) * 225 / 300)
    assert sum(r.kept for r in got) == k
    least = min(r.gumbel_key for r in got if r.kept)
    assert all(r.gumbel_key <= least for r in got if not r.kept)
    unseen = [r for r in got if r.doc_id is not None and 300 <= r.doc_id < 600]
    assert sum(r.kept == (r.doc_id % 4 != 0) for r in unseen) >= 0.97 * len(unseen)
    empty = next(r for r in got if r.doc_id == 5000)
    assert empty.log_weight == 0.0


def test_gumbel_sampling_is_in_proportion(spark):
    """With weights 1 and 3, the heavier of two documents comes first three times in four."""
    from pyspark.sql import functions as F

    from orderloom.llm.mixing import unit

    pairs = spark.range(20000)
    noise = [-F.log(-F.log(unit(F.lit(f"g{j}"), F.col("id")))) for j in range(2)]
    first = pairs.select((noise[0] + F.log(F.lit(3.0)) > noise[1]).cast("int").alias("first"))
    assert abs(first.agg({"first": "avg"}).first()[0] - 0.75) < 0.015


def test_long_runs_do_not_end_the_matcher(spark):
    """A million rounds of a repeated group, per generator; a stack per round would overflow."""
    from orderloom.llm.personal_data import GENERATORS

    n = 1_000_000
    texts = [
        "x@" + "a." * n + "a", "a[at]b" + ".c" * n, "a(at)b" + "[dot]c" * (n // 5), "1" * n, "1 " * (n // 2) + "1",
        "+" * n, "+1" + "(2)" * (n // 3) + "3", "1." * (n // 2) + "1", "a@" * (n // 2), "+1 " * (n // 3),
    ]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    columns = [F.regexp_count("text", F.lit(g.pattern)).alias(f"g{i}") for i, g in enumerate(GENERATORS)]
    rows = {r.doc_id: r for r in frame.select("doc_id", *columns).collect()}
    assert len(rows) == len(texts) and rows[0]["g0"] == 1 and rows[1]["g4"] == 1


def test_trees_and_thresholds_of_personal_data_use_all_candidates(spark):
    """25,000 candidates, more than the trees were once fitted on, in a few forms."""
    import glob

    from orderloom.scratch import _folder

    n = 25_000
    found = spark.range(n).select(
        F.col("id").alias("_row"),
        F.lit(0).alias("generator"),
        F.lit(0).alias("start"),
        F.lit("ip").alias("kind"),
        (F.col("id") % 5 == 0).alias("proved"),
        (F.col("id") % 5).cast("double").alias("x_form"),
    )
    before = set(glob.glob(f"{_folder(spark)}/pii-*"))
    trees, limits = personal_data.fit(found)
    (path,) = set(glob.glob(f"{_folder(spark)}/pii-*")) - before
    forms = spark.read.parquet(path)
    assert forms.agg(F.sum("weight")).first()[0] == n and forms.count() == 10
    assert trees is not None and limits["ip"] <= 1 < limits["email"]
