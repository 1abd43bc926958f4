"""From raw documents to files of token ids, in five stages.

Each stage takes the documents that the one before it kept, as a written table, and the
folder of the given tables.  All but the last return documents with their own columns.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from orderloom.llm.common import table
from orderloom.llm.decontamination import clean_documents
from orderloom.llm.mixing import mix_sources
from orderloom.llm.ngram_join import one_of_each_group
from orderloom.llm.quality_rules import keep_documents
from orderloom.llm.tokens import token_digests, vocabulary_path, write_token_files
from orderloom.scratch import drop_staged, new_path, scope, stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
SCOPE = "pipeline-stage"


def own_tables(step: Stage) -> Stage:
    """The stage keeps its written tables in a folder of its own.

    They are needed until its result is written, so the next stage, which gets that copy,
    removes them first.
    """

    @wraps(step)
    def run_step(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop_staged(spark, SCOPE)
        with scope(SCOPE):
            return step(spark, docs, sf_dir)

    return run_step


@own_tables
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass their own rules and whose host is not rejected."""
    return keep_documents(docs)


@own_tables
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, with the smallest id, of each group of near copies: five-word
    shingles, Jaccard similarity of at least 0.8."""
    return one_of_each_group(docs)


@own_tables
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no passage with the benchmark."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


@own_tables
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in equal shares, by copies, in a random order."""
    return mix_sources(docs).select(*docs.columns)


@own_tables
def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Compressed files of token ids, and what is read back from them: a row per copy of a
    document with its place in the stream of ids, its length and its checksum."""
    out = new_path(spark, "pipeline-tokens")
    write_token_files(docs, out, vocabulary_path("word_bpe_49k.json"), end_id=1)
    return token_digests(spark, out)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token files", token_files),
]

# The last stage's checksums of token ids are beyond SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for number, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = stage(docs, f"pipeline-{name.replace(' ', '-')}")
    return docs
