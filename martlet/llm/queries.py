"""The registered ``opN_*`` queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from martlet.llm import oracle
from martlet.llm._io import table
from martlet.llm.ann import nearest_digest
from martlet.llm.audit import filter_audit
from martlet.llm.decontaminate import contamination_digest
from martlet.llm.html import extracted_pages
from martlet.llm.jaccard import jaccard_digest
from martlet.llm.langid import language_digest
from martlet.llm.mix import mix_digest
from martlet.llm.packing import packing_digest
from martlet.llm.shard import sharded_digest
from martlet.llm.spelling import spelling_digest
from martlet.llm.substrings import substring_digest
from martlet.llm.toxicity import toxicity_digest
from martlet.llm.urls import judged_pages


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_digest(table(spark, sf_dir, "documents"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_digest(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_digest(table(spark, sf_dir, "documents"))


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_digest(table(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded_digest(table(spark, sf_dir, "documents"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted_pages(table(spark, sf_dir, "pages"))


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_digest(table(spark, sf_dir, "embeddings"))


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged_pages(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_digest(table(spark, sf_dir, "documents"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing_digest(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_mixing": op1_mixing,
        "op2_jaccard_join": op2_jaccard_join,
        "op3_toxicity": op3_toxicity,
        "op4_decontamination": op4_decontamination,
        "op5_language_id": op5_language_id,
        "op6_suffix_array_dedup": op6_suffix_array_dedup,
        "op7_sharding": op7_sharding,
        "op8_html_extraction": op8_html_extraction,
        "op9_nearest_neighbours": op9_nearest_neighbours,
        "op10_url_filters": op10_url_filters,
        "op11_filter_audit": op11_filter_audit,
        "op12_spelling_variants": op12_spelling_variants,
        "op13_packing": op13_packing,
    }


def oracle_sql() -> dict[str, str]:
    return oracle.all_sql()
