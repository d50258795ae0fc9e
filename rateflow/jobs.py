"""Batch jobs: each reads the base tables and replaces its derived tables.

Tables live under one folder: ``Product`` and ``Rating`` (with the rows that did
not parse beside them), the statistics, the recommendation lists of each model,
and ``Similarity``, which the scoring stream reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rateflow.operators import als, content, itemcf, stats
from rateflow.operators.topk import nest, rank_within
from rateflow.schemas import PRODUCT_RECS, RATING, SIMILARITY, USER_RECS
from rateflow.sources import tables, text
from rateflow.streaming.jobs import write_history, write_similarities


def load(spark: SparkSession, base: str, products_path: str, ratings_path: str) -> None:
    """Text files -> Product and Rating; rejected rows -> ProductRejects and RatingRejects."""
    for name, (good, bad) in {"Product": text.read_products_text(spark, products_path),
                              "Rating": text.read_ratings_text(spark, ratings_path)}.items():
        tables.write_table(good, f"{base}/{name}")
        tables.write_table(bad, f"{base}/{name}Rejects")


def statistics(spark: SparkSession, base: str) -> None:
    ratings = tables.read_ratings(spark, f"{base}/Rating")
    tables.write_table(stats.rate_more_products(ratings), f"{base}/RateMoreProducts")
    tables.write_table(stats.rate_more_recently_products(ratings), f"{base}/RateMoreRecentlyProducts")
    tables.write_table(stats.average_products(ratings), f"{base}/AverageProducts")


def co_rating(spark: SparkSession, base: str) -> None:
    """The ten most co-rated products of each product, nested."""
    recs = itemcf.product_recs(tables.read_ratings(spark, f"{base}/Rating"))
    tables.write_table(_typed(recs, PRODUCT_RECS), f"{base}/ItemCFProductRecs")


def content_based(spark: SparkSession, base: str, k: int | None = None) -> None:
    """Products of similar tags, nested; ``k`` limits the lists."""
    recs = content.product_recs(tables.read_products(spark, f"{base}/Product"), k=k)
    tables.write_table(_typed(nest(recs, "productId"), PRODUCT_RECS), f"{base}/ContentBasedProductRecs")


def factors(spark: SparkSession, base: str, k: int | None = None, **model) -> None:
    """Fit the factor model -> UserRecs, ProductRecs, the Similarity table and its form in product
    buckets, SimilarityByProduct, that the stream reads by key.

    ``model`` holds rank, max_iter, reg and seed; ``k`` limits the product lists.
    """
    fitted = als.fit(tables.read_ratings(spark, f"{base}/Rating"), **model)
    tables.write_table(_typed(als.user_recs(fitted), USER_RECS), f"{base}/UserRecs")
    tables.write_table(_typed(als.similarity_table(als.product_recs(fitted, k=k)), SIMILARITY), f"{base}/Similarity")
    stored = tables.read_table(spark, f"{base}/Similarity", SIMILARITY)
    write_similarities(stored, f"{base}/SimilarityByProduct")
    similar = stored.withColumnRenamed("sim", "score")
    ranked = rank_within(similar, ["productId"], [als.rank_key("score").desc(), "simProductId"])
    tables.write_table(_typed(nest(ranked, "productId"), PRODUCT_RECS), f"{base}/ProductRecs")


def history(spark: SparkSession, base: str) -> None:
    """Rating in the user buckets that the scoring stream reads."""
    write_history(tables.read_ratings(spark, f"{base}/Rating").select(*RATING.fieldNames()), f"{base}/History")


def _typed(df: DataFrame, schema) -> DataFrame:
    return df.select(*[df[f.name].cast(f.dataType) for f in schema.fields])
