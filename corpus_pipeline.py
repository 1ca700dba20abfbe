"""Corpus pipeline over ``documents``: each stage's result is written and read again.

Stages take (spark, docs, sf_dir); all but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from surfrank.llm import bpe, exact_dedup, jaccard_join, langid, mixing
from surfrank.llm.common import read, scratch_path
from surfrank.llm.queries import PATTERN, RANKS


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language identifier rejects go."""
    return langid.accepted(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return exact_dedup.keep_first(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, similarity 0.8."""
    return jaccard_join.keep_one(docs, k=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.repeated(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix, checked by decoding."""
    return bpe.round_trip(docs, RANKS, PATTERN)


STAGES = [
    ("language_id", language),
    ("exact_dedup", exact),
    ("ngram_jaccard", near),
    ("source_mix", mix),
    ("byte_bpe", tokens),
]

#: Learned models and tokenisation cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
