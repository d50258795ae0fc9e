"""The training-data queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from rateflow.llm import (chat, html_text, license_scan, line_dedup, mixing, order_minhash, packing, pivot_search,
                          quality_classifier, quality_rules, target_resampling, warc, whitening)
from rateflow.llm.common import table


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents", "doc_id", "text"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = mixing.mix(table(spark, sf_dir, "documents", "doc_id", "source", "text"))
    return drawn.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.classify(table(spark, sf_dir, "documents", "doc_id", "text"),
                                       table(spark, sf_dir, "labels", "doc_id", "quality"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.verdicts(table(spark, sf_dir, "documents", "doc_id", "text"))


def op6_pivot_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_search.top_k(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.expr("vec_id % 50 = 0"))


def op7_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.classes(table(spark, sf_dir, "documents", "doc_id", "text")).select(
        "doc_id", "class_id", "class_size", "is_first")


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(table(spark, sf_dir, "pages", "page_id", "url", "html"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.digests(chat.with_probe(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents", "doc_id", "text"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digests(table(spark, sf_dir, "documents", "doc_id", "text"))


def op13_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = target_resampling.resample(table(spark, sf_dir, "documents", "doc_id", "text"),
                                       table(spark, sf_dir, "benchmark", "text"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_license_scan, op2_warc, op3_mixing, op4_quality_classifier, op5_quality_rules, op6_pivot_search,
    op7_order_minhash, op8_html_text, op9_chat_format, op10_packing, op11_whitening, op12_line_dedup,
    op13_target_resampling)}

# Without SQL: op3 (random draws), op4 (a learned model), op7 (alignment), op8 (HTML
# parsing), op10 (tokenization) and op11 (eigenvectors); their tests compare with brute force.
ORACLE: dict[str, str] = {
    "op1_license_scan": license_scan.oracle(),
    "op2_warc": warc.ORACLE,
    "op5_quality_rules": quality_rules.ORACLE,
    "op6_pivot_search": pivot_search.ORACLE,
    "op9_chat_format": chat.ORACLE,
    "op12_line_dedup": line_dedup.ORACLE,
    "op13_target_resampling": target_resampling.ORACLE,
}
