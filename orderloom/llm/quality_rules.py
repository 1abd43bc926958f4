"""Host-level quality rules, in SQL functions only.

Texts are judged by rules of their own first.  Failures are then counted per host, a beta
prior is fitted to the hosts' rates, and each host's rate is shrunk towards it, so that a
host with few documents is not condemned by them.  The verdict on the host goes back to
its documents.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import whole_text
from orderloom.scratch import stage

SPACES = " \t\n\u000b\f\r"
HAS_WORD = r"[^\x20\x09-\x0D]"
SYMBOL, OTHERS = "[#*$%&|<>]", "[^#*$%&|<>]+"


@dataclass(frozen=True)
class HostRules:
    """Limits of the rules.

    A host is rejected when its shrunken rate of failing documents is above
    ``host_limit`` (or that of documents with many symbols, or with many repeated lines,
    which count as failures of the host and never reject a document on their own).
    """

    min_words: int = 50
    repeat_percent: int = 50
    symbol_percent: int = 10
    dup_line_percent: int = 30
    host_limit: float = 0.5


def words_of(text: Column) -> Column:
    """Words between ASCII white space."""
    inner = F.btrim(text, F.lit(SPACES))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(
        F.split(inner, r"[\x20\x09-\x0D]+")
    )


def with_repeated_words(df: DataFrame, out: str, words: str = "_words") -> DataFrame:
    """Add the number of words that lie in a 3-word window found twice or more.

    A window is its hash, with the low bits replaced by its place: as many bits as the
    text needs, so one sort of longs puts equal windows side by side.  Neighbours with
    equal hash bits are compared word by word.  Linear but for the sort, in each row.
    Each array is a column of its own, so that it is computed once per row.
    """
    w = F.col(words)
    low, high = F.col("_low"), F.bitwise_not("_low")

    def window(i: Column) -> Column:
        key = F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
        return key.bitwiseAND(high).bitwiseOR(i.cast("long"))

    def same(a: Column, b: Column) -> Column:
        i, j = a.bitwiseAND(low).cast("int"), b.bitwiseAND(low).cast("int")
        equal = (
            (F.get(w, i) == F.get(w, j))
            & (F.get(w, i + 1) == F.get(w, j + 1))
            & (F.get(w, i + 2) == F.get(w, j + 2))
        )
        return F.when(a.bitwiseAND(high) == b.bitwiseAND(high), equal).otherwise(False)

    packed, places = F.col("_packed"), F.col("_places")

    def repeated(x: Column, k: Column) -> Column:
        return same(x, F.get(packed, k + 1)) | (
            F.when(k > 0, same(x, F.get(packed, k - 1))).otherwise(False)
        )

    bits = F.ceil(F.log2(F.size(w) + F.lit(1))).cast("int")
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1
    windows = F.transform(F.sequence(F.lit(0), F.size(w) - 3), window)
    found = F.transform(F.filter(packed, repeated), lambda x: x.bitwiseAND(low).cast("int"))
    reach = F.transform(
        places, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(places, k + 1) - p, F.lit(3)))
    )
    covered = F.aggregate(reach, F.lit(0).cast("long"), lambda total, step: total + step)
    return (
        df.withColumn("_low", mask)
        .withColumn("_packed", F.when(F.size(w) > 3, F.sort_array(windows)))
        .withColumn("_places", F.sort_array(found))
        .withColumn(out, F.coalesce(covered, F.lit(0).cast("long")))
        .drop("_low", "_packed", "_places")
    )


def text_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words.

    A null text counts as empty.  Lines are split at newlines, and only lines with a word
    count; a duplicate is a line equal to an earlier one.
    """
    raw = whole_text(text)
    lines = F.filter(F.split(raw, "\n"), lambda x: x.rlike(HAS_WORD))
    split = docs.withColumn("_words", words_of(raw)).withColumn("_lines", lines)
    measured = split.select(
        *docs.columns,
        "_words",
        F.size("_words").cast("long").alias("n_words"),
        F.char_length(F.concat_ws("", "_words")).cast("long").alias("word_chars"),
        F.when(raw.rlike(SYMBOL), F.length(F.regexp_replace(raw, OTHERS, "")))
        .otherwise(F.lit(0))
        .cast("long")
        .alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
    )
    return with_repeated_words(measured, "n_repeat_words").drop("_words")


def base_failed(rules: HostRules = HostRules()) -> Column:
    return (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.repeat_percent * F.col("n_words")
    )


def _flags(rules: HostRules) -> dict[str, Column]:
    return {
        "base": base_failed(rules),
        "symbols": 100 * F.col("n_symbols") > rules.symbol_percent * F.col("word_chars"),
        "lines": 100 * F.col("n_dup_lines") > rules.dup_line_percent * F.col("n_lines"),
    }


def host_rates(measured: DataFrame, host: str = "source", rules: HostRules = HostRules()) -> DataFrame:
    """Per host: documents, failures per rule, and rates shrunk by a fitted beta prior.

    The prior of a rule has the mean m of the failure rate over all documents and the
    strength s that the hosts' scatter implies by the method of moments: with v the
    document-weighted variance of the hosts' rates, and w what sampling alone would give,
    the rates' own variance is v - w and s = m (1 - m) / (v - w) - 1.  Where the scatter is
    no greater than sampling gives, all hosts share the mean.  The null host is a host.
    """
    flags = _flags(rules)
    counts = measured.groupBy(F.col(host).alias("_host")).agg(
        F.count("*").alias("docs"),
        *[F.sum(F.when(flag, 1).otherwise(0)).alias(name) for name, flag in flags.items()],
    )
    n = F.col("docs")
    sums = [F.count("*").alias("_hosts"), F.sum(n).alias("_n")]
    for name in flags:
        f = F.col(name)
        sums += [F.sum(f).alias(f"_f_{name}"), F.sum(f * f / n).alias(f"_q_{name}")]
    # one row
    moments = counts.agg(*sums)
    joined = counts.crossJoin(F.broadcast(moments))
    hosts, total = F.col("_hosts"), F.col("_n")
    shrunk = []
    for name in flags:
        m = F.col(f"_f_{name}") / total
        spread = m * (1 - m)
        v = F.col(f"_q_{name}") / total - m * m
        w = spread * hosts / total
        own = v - w
        strength = F.when(own > 0, F.greatest(spread / own - 1, F.lit(0.0)))
        rate = (F.col(name) + strength * m) / (n + strength)
        shrunk.append(F.coalesce(rate, m).alias(f"{name}_rate"))
    return joined.select("_host", "docs", *flags, *shrunk)


def rejected_hosts(
    measured: DataFrame, host: str = "source", rules: HostRules = HostRules()
) -> DataFrame:
    rates = host_rates(measured, host, rules)
    worst = F.greatest(*[F.col(f"{name}_rate") for name in _flags(rules)])
    return rates.where(worst > rules.host_limit).select("_host", F.lit(True).alias("_rejected"))


def judge_documents(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    host: str = "source",
    rules: HostRules = HostRules(),
) -> DataFrame:
    """Measures, base_failed and kept of each document.

    kept is false if base_failed or if the document's host is rejected.  Null texts are
    empty and fail; a null host is a host of its own.  Repeated rows are judged one by
    one.  Other columns are not read.  Empty tables give no rows.

    The measures are written once, narrow; hosts are counted with partial sums, and only
    rejected hosts are joined back, so a host with a third of all rows is not moved as
    long as Spark measures their list to be small, and is split by the skew join if not.
    """
    own = docs.select(
        F.col(key).alias("doc_id"), F.col(text).alias("text"), F.col(host).alias("_of")
    )
    measured = stage(text_measures(own).drop("text"), "measures")
    bad = stage(rejected_hosts(measured, "_of", rules), "rejected-hosts")
    failed = base_failed(rules)
    joined = measured.join(bad, F.col("_of").eqNullSafe(F.col("_host")), "left")
    return joined.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & F.col("_rejected").isNull()).alias("kept"),
    )


def keep_documents(
    docs: DataFrame, text: str = "text", host: str = "source", rules: HostRules = HostRules()
) -> DataFrame:
    """The documents that pass, with their own columns."""
    plain = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_doc"))
    own = plain.select(
        "_doc", F.col(f"_doc.`{text}`").alias("text"), F.col(f"_doc.`{host}`").alias("_of")
    )
    measured = stage(text_measures(own).drop("text"), "measured-documents")
    bad = stage(rejected_hosts(measured, "_of", rules), "rejected-hosts")
    good = measured.where(~base_failed(rules))
    joined = good.join(bad, F.col("_of").eqNullSafe(F.col("_host")), "left_anti")
    return joined.select("_doc.*")
