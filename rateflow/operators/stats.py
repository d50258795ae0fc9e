"""Rating statistics: most rated, most rated per month, best mean score."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateflow.functions.exprs import year_month


def rate_more_products(ratings: DataFrame, descending: bool = False) -> DataFrame:
    """Ratings per product.  The original list is sorted by count ascending."""
    c = ratings.groupBy("productId").agg(F.count("productId").alias("count"))
    return c.orderBy(F.col("count").desc() if descending else F.col("count").asc(), "productId")


def rating_year_month(ratings: DataFrame) -> DataFrame:
    return ratings.select("productId", "score", year_month("timestamp").alias("yearmonth"))


def rate_more_recently_products(ratings: DataFrame) -> DataFrame:
    """Ratings per (month, product), newest month first, then most rated."""
    c = (rating_year_month(ratings)
         .groupBy("yearmonth", "productId")
         .agg(F.count("productId").alias("count")))
    return (c.select("productId", "count", "yearmonth")
            .orderBy(F.col("yearmonth").desc(), F.col("count").desc(), "productId"))


def average_products(ratings: DataFrame) -> DataFrame:
    a = ratings.groupBy("productId").agg(F.avg("score").alias("avg"))
    return a.orderBy(F.col("avg").desc(), "productId")


def distinct_users(ratings: DataFrame) -> DataFrame:
    return ratings.select("userId").distinct()


def distinct_products(ratings: DataFrame) -> DataFrame:
    return ratings.select("productId").distinct()
