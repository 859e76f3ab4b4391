"""The corpus pipeline: documents with a language, without exact and near copies or benchmark leaks, as tokens.

Each stage reads what the one before it wrote and decides on its own input; all but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeops.llm.common import stored, table
from lakeops.llm.exact_dedup import without_copies
from lakeops.llm.langid import with_language
from lakeops.llm.leaks import without_leaks
from lakeops.llm.near_dedup import without_near_copies
from lakeops.llm.pieces import token_digests


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; those without a letter or a likely language go."""
    return with_language(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each set of equal texts."""
    return without_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component."""
    return without_near_copies(docs)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    return token_digests(docs)


STAGES = [("language", language), ("exact_dedup", exact), ("near_dedup", near), ("decontamination", leaks), ("sentencepiece", tokens)]
# Trained scores and sub-word merges can't be written in SQL; tests compare columns and counts, not the ids each stage keeps.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
