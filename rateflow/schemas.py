"""Fixed schemas of the rating / product / recommendation tables."""

from pyspark.sql import types as T

PRODUCT = T.StructType([
    T.StructField("productId", T.IntegerType()),
    T.StructField("name", T.StringType()),
    T.StructField("imageUrl", T.StringType()),
    T.StructField("categories", T.StringType()),
    T.StructField("tags", T.StringType()),
])

RATING = T.StructType([
    T.StructField("userId", T.IntegerType()),
    T.StructField("productId", T.IntegerType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("timestamp", T.IntegerType()),
])

RECOMMENDATION = T.StructType([
    T.StructField("productId", T.IntegerType()),
    T.StructField("score", T.DoubleType()),
])

PRODUCT_RECS = T.StructType([
    T.StructField("productId", T.IntegerType()),
    T.StructField("recs", T.ArrayType(RECOMMENDATION)),
])

USER_RECS = T.StructType([
    T.StructField("userId", T.IntegerType()),
    T.StructField("recs", T.ArrayType(RECOMMENDATION)),
])

# Flat similarity table that the models write and scoring reads: one row per ordered product pair.
SIMILARITY = T.StructType([
    T.StructField("productId", T.IntegerType()),
    T.StructField("simProductId", T.IntegerType()),
    T.StructField("sim", T.DoubleType()),
])
