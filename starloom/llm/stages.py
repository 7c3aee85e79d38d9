"""Stages of the corpus pipeline; each takes the session, the documents kept so far and the folder of the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.llm import minhash, mixing, personal, quality
from starloom.llm.queries import quality_rules, token_digests


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base limits and the learned rules keep."""
    return quality.kept_documents(docs, quality_rules(spark, sf_dir, docs))


def duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return minhash.distinct_documents(docs)


def personal_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data replaced by its kind."""
    return personal.redacted_documents(docs, personal.fitted(docs))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the token ids of each row and of their decoding."""
    return token_digests(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("MinHash near-dedup", duplicates_stage),
    ("personal data", personal_stage),
    ("mixing", mixing_stage),
    ("byte-level BPE", token_stage),
]
