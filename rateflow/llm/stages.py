"""Operators as pipeline stages: documents in, documents out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from rateflow.llm import mixing, order_minhash, packing, quality_classifier, quality_rules
from rateflow.llm.common import table


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the current rule policy; the others go."""
    rows = quality_rules.ledger(docs, "text", prefix="__rule_")
    return rows.where(quality_rules.passes(failures="__rule_failures")).select(*docs.columns)


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on those at hand, takes for good ones."""
    model = quality_classifier.train(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    return quality_classifier.score(docs, model, name="__score").where("__score >= 0.5").select(*docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: that of the smallest doc_id."""
    return order_minhash.deduplicated(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: never, once or twice."""
    drawn = (mixing.mix(docs).groupBy(F.col("row").alias("__row_key"))
             .agg(F.sum("copies").alias("__copies")).where("__copies > 0"))
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("__row"),
                        F.xxhash64("doc_id", "text").alias("__row_key"))
    # Equal rows share a key: their copies are added up above and dealt from one of them.
    nth = F.row_number().over(Window.partitionBy("__row_key").orderBy(F.lit(0)))
    one = whole.join(drawn, "__row_key").withColumn("__nth", nth).where("__nth = 1")
    return one.select("__row", F.explode(mixing.copies_column(F.col("__copies"))).alias("__copy")).select("__row.*")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces of the mix."""
    return packing.pack(docs)
