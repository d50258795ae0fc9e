"""Corpus pipeline: rules, classifier, near-duplicates, mix, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rateflow.llm import stages
from rateflow.session import scratch_path

STAGES = [
    ("quality_rules", stages.quality_rules_stage),
    ("quality_classifier", stages.quality_classifier_stage),
    ("near_dedup", stages.near_dedup_stage),
    ("mixing", stages.mixing_stage),
    ("packing", stages.packing_stage),
]

# A learned model, alignments, random draws and tokenization are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
