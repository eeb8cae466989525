"""A training corpus from raw documents: five stages, each written and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from secflow.llm import stages
from secflow.llm.common import stored, table

STAGES = [
    ("language", stages.known_languages),
    ("near_duplicates", stages.without_near_duplicates),
    ("decontamination", stages.without_benchmark),
    ("mixture", stages.mixed_sources),
    ("token_files", stages.token_ids),
]

#: SQL cannot express language models, near-duplicates or token ids; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; what one keeps is written as Parquet and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
