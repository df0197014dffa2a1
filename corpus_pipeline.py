"""Corpus pipeline over ``documents``: each stage's rows are written and reread by the next.

Language identification drops documents without a language, the n-gram join
leaves one document of each group of near duplicates, decontamination drops
documents that quote the benchmark, mixing takes each source's share (a row
for every pass over a document, with the text taken), and sharding gives every
row a shard and a slot. All stages but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlet.llm._io import Scratch, table
from martlet.llm.decontaminate import clean_documents
from martlet.llm.jaccard import one_of_each
from martlet.llm.langid import identified_documents
from martlet.llm.mix import mixed_texts
from martlet.llm.shard import shuffle_into_shards


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return identified_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_texts(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    size = F.octet_length(F.coalesce(F.col("text"), F.lit(""))) + 1
    return shuffle_into_shards(docs, "doc_id", size)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

# Hash permutations and a trained model: SQL cannot express the rows; tests hold them against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over all documents."""
    docs = table(spark, sf_dir, "documents")
    scratch = Scratch(spark, "pipeline")
    for name, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
