"""A training-data pipeline over `documents`: quality rules, near duplicates, personal data, mixing, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.llm.stages import STAGES
from starloom.session import materialize

#: The rows depend on learned models, so SQL cannot express them; tests/llm/test_corpus_pipeline.py checks them instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other; each result is written and read again as the next one's documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs)
    return docs
