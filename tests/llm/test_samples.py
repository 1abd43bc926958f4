from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from shared import frame, prose

from orderloom.llm import importance, tokens, toxicity


def test_rare_targets_are_all_sampled(spark):
    """One label in a hundred is a target: fewer than the sample may hold, so all are in it."""
    ids = spark.range(400_000)
    labels = ids.select(F.col("id").alias("doc_id"), (F.col("id") % 100 == 0).cast("int").alias("quality"))
    assert importance._target_sample(labels, "doc_id", "quality").count() == 4000


@pytest.mark.parametrize("module", [toxicity, tokens])
def test_hash_bound_is_sized_by_the_rows_that_are_drawn_from(spark, monkeypatch, module):
    sizes, drawn = [], module.least_hashed

    def noted(df, hashed, most, total):
        sizes.append((df.count(), total))
        return drawn(df, hashed, most, total)

    monkeypatch.setattr(module, "least_hashed", noted)
    docs = frame(spark, [(i, prose(i, 20) if i % 3 else "", "s") for i in range(30)])
    if module is tokens:
        path = tokens.vocabulary_path("word_bpe_49k.json")
        tokens._train(docs.select("doc_id", "text"), path, 1, "<u2", 1024)
    else:
        rows = [(i // 2, 1 if i % 3 else None) for i in range(40)] + [(None, 1)]
        labels = spark.createDataFrame(rows, "doc_id long, toxic int")
        toxicity.train(docs, labels)
    assert sizes == [(20, 20)]
