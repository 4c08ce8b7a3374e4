"""A training corpus from ``documents``: language ID, quality rules, near-dedup,
benchmark decontamination, packing.  Each stage reads what its predecessor kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from lodestar.llm import decontaminate, language_id, near_dedup, packing, quality_rules
from lodestar.llm.queries import table, vocabulary_path
from lodestar.session import work_dir


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised with a score of at least 0.5."""
    return language_id.keep_known(docs)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised rules judge good."""
    return quality_rules.keep_good(docs)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest id) of each group of near-duplicates: five-word shingles, similarity 0.8."""
    return near_dedup.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no ten-word window with a benchmark item."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the kept documents in sequences of 2048 tokens."""
    return packing.pack(docs, vocabulary_path())


STAGES = [
    ("language_id", known_language),
    ("quality_rules", good_quality),
    ("near_dedup", without_copies),
    ("decontamination", without_benchmark),
    ("packing", packed),
]
# a trained network, expectation-maximisation and fitted patterns are beyond SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each stage keeps is written to the
    shared folder (``spark.checkpoint.dir``) and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{work_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
