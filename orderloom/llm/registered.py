"""The registered queries of this subpackage: each applies one operator to whole tables."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import sql_twins
from orderloom.llm.collocations import collocations
from orderloom.llm.common import table
from orderloom.llm.decontamination import contaminated_documents
from orderloom.llm.hard_negatives import hard_negatives, relabelled
from orderloom.llm.importance import resample
from orderloom.llm.main_text import extract_main_text
from orderloom.llm.mixing import mix_sources
from orderloom.llm.ngram_join import near_duplicate_components
from orderloom.llm.personal_data import private_documents
from orderloom.llm.quality_rules import judge_documents
from orderloom.llm.sharding import shard_documents
from orderloom.llm.tokens import (
    token_counts,
    token_digests,
    vocabulary_path,
    write_token_files,
)
from orderloom.llm.toxicity import toxic_documents
from orderloom.scratch import new_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), shards=40)


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_components(table(spark, sf_dir, "documents"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_documents(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.json"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated_documents(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private_documents(table(spark, sf_dir, "documents"))


def op7_quality_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxic_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = new_path(spark, "token-files")
    write_token_files(
        table(spark, sf_dir, "documents"), out, vocabulary_path("word_bpe_49k.json"), end_id=1
    )
    return token_digests(spark, out)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = relabelled(table(spark, sf_dir, "embeddings"))
    return hard_negatives(rows, is_anchor=F.col("vec_id") % 50 == 0)


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_sharding": op1_sharding,
    "op2_ngram_jaccard_join": op2_ngram_jaccard_join,
    "op3_quality_rules": op3_quality_rules,
    "op4_token_counts": op4_token_counts,
    "op5_decontamination": op5_decontamination,
    "op6_personal_data": op6_personal_data,
    "op7_quality_resampling": op7_quality_resampling,
    "op8_toxicity": op8_toxicity,
    "op9_token_files": op9_token_files,
    "op10_mixing": op10_mixing,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_html_extraction": op12_html_extraction,
    "op13_collocations": op13_collocations,
    "pipeline": corpus_pipeline.run,
}

ORACLES: dict[str, str] = {
    "op2_ngram_jaccard_join": sql_twins.NGRAM_JACCARD,
    "op3_quality_rules": sql_twins.QUALITY_RULES,
    "op10_mixing": sql_twins.MIXING,
    "op11_hard_negatives": sql_twins.HARD_NEGATIVES,
    "op13_collocations": sql_twins.COLLOCATIONS,
}
