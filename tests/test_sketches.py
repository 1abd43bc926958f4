from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from orderloom.operators import profile, sketches
from orderloom.scratch import stage


@pytest.fixture(scope="module")
def table(spark):
    k = F.col("id")
    return spark.range(30_000).select(
        k.alias("key"),
        F.when(k % 10 > 0, (k % 997).cast("double")).alias("amount"),
        F.when(k % 3 == 0, "common").otherwise(F.concat(F.lit("rare"), (k % 5000).cast("string"))).alias("name"),
        F.concat(F.lit("a text longer than the longest label that is kept as it is, number "), (k % 7).cast("string")).alias("long"),
        F.array((k % 4).cast("float")).alias("list"),
        F.lit(None).cast("int").alias("nothing"),
        (k % 6).alias("slice"),
    )


def by_column(frame):
    return {r["column"]: r for r in frame.collect()}


def test_estimates_are_within_their_errors(table):
    found = sketches.estimates(sketches.sketch(table))
    for row in sketches.check_estimates(table, found).collect():
        assert row["distinct_within"] and row["top_within"] and row["quartiles_within"] is not False


def test_merged_slices_equal_one_pass(table):
    whole = by_column(sketches.estimates(sketches.sketch(table.drop("slice"))))
    slices = stage(sketches.sketch(table, "slice"), "slices")
    assert slices.count() == 6 * 6
    merged = by_column(sketches.estimates(sketches.merge(slices)))
    for name, row in whole.items():
        other = merged[name]
        assert (row["rows"], row["nulls"]) == (other["rows"], other["nulls"])
        assert other["distinct_estimate"] == row["distinct_estimate"]
        top = {e["item"]: e["count"] for e in other["top_values"]}
        assert all(abs(top.get(e["item"], e["count"]) - e["count"]) <= 30 for e in row["top_values"])
    assert merged["name"]["top_values"][0]["item"] == "common"
    checked = by_column(sketches.check_estimates(table.drop("slice"), sketches.estimates(sketches.merge(slices))))
    assert all(r["distinct_within"] and r["top_within"] for r in checked.values())
    assert checked["amount"]["quartiles_within"]


def test_a_wrong_estimate_is_told(table):
    slim = table.select("key", "amount")
    found = sketches.estimates(sketches.sketch(slim))
    wrong = found.withColumn("distinct_estimate", F.col("distinct_estimate") * 2).withColumn(
        "quartiles", F.transform("quartiles", lambda q: q * 2)
    )
    for row in sketches.check_estimates(slim, wrong).collect():
        assert not row["distinct_within"] and not row["quartiles_within"]


def test_long_values_stay_apart(table):
    (row,) = sketches.estimates(sketches.sketch(table.select("long"))).collect()
    assert len({e["item"] for e in row["top_values"]}) == 7


def test_empty_table(table):
    empty = table.limit(0)
    for row in sketches.estimates(sketches.sketch(empty)).collect():
        assert (row["rows"], row["distinct_estimate"], row["top_values"]) == (0, 0, [])


def test_exact_profile(table):
    rows = by_column(profile.profile(table, exact=True))
    assert rows["key"]["distinct_values"] == 30_000 and rows["amount"]["distinct_values"] == 997
    assert rows["nothing"]["distinct_values"] == 0 and rows["nothing"]["nulls"] == 30_000
    assert rows["amount"]["nulls"] == 3000 and rows["list"]["distinct_values"] == 4
    assert "Expand" not in profile.profile(table, exact=True)._jdf.queryExecution().toString()
