"""The corpus pipeline: five stages, each a DataFrame written before the next reads it.

A stage gets what its predecessor kept and returns the columns of ``documents`` (the
last one: packed pieces). Clean documents pass; what a stage rejects is gone for all
later ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from salescope.llm.bm25_leaks import drop_leaking
from salescope.llm.exact_dedup import drop_copies
from salescope.llm.jaccard_join import keep_one
from salescope.llm.language_crf import keep_identified
from salescope.llm.packing import pack
from salescope.llm.textops import materialize


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter, or with no clear language, go."""
    return keep_identified(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of texts that differ in white space at most stays."""
    return drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays: five-word shingles, similarity 0.8."""
    return keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item's question and answer go."""
    return drop_leaking(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return pack(docs)


STAGES = [
    ("language_crf", language),
    ("exact_dedup", exact),
    ("jaccard_join", near),
    ("benchmark_leaks", decontaminate),
    ("packing", packed),
]

# Learned fields, retrieval and tokens are not SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every intermediate result is a written table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
