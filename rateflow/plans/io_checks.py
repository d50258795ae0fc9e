"""Loader, parser, scan and write queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from rateflow.schemas import PRODUCT, RATING
from rateflow.plans.registry import register
from rateflow.session import scratch_path
from rateflow.sources import fixtures as fx
from rateflow.sources import tables, text

_TRIM = "'^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g'"


def _trim(x: str) -> str:
    return f"regexp_replace({x}, {_TRIM})"


@register("load_products", fx.with_views("product_lines", f"""parsed AS (
  SELECT string_split(regexp_replace(value, '(?:\\^)+$', ''), '^') AS f FROM product_lines)""") + f"""
SELECT TRY_CAST(f[1] AS INTEGER) AS productId, {_trim('f[2]')} AS name,
       {_trim('f[5]')} AS imageUrl, {_trim('f[6]')} AS categories, {_trim('f[7]')} AS tags
FROM parsed WHERE len(f) >= 7 AND TRY_CAST(f[1] AS INTEGER) IS NOT NULL
""")
def _load_products(spark, d):
    good, _ = text.split_good_bad(text.parse_product_lines(fx.product_lines(spark, d)),
                                  PRODUCT.fieldNames())
    return good


_RATING_CASTS = """TRY_CAST(f[1] AS INTEGER) AS userId, TRY_CAST(f[2] AS INTEGER) AS productId,
       TRY_CAST(f[3] AS DOUBLE) AS score, TRY_CAST(f[4] AS INTEGER) AS "timestamp\""""
_ALL_CAST = """len(f) >= 4 AND TRY_CAST(f[1] AS INTEGER) IS NOT NULL
  AND TRY_CAST(f[2] AS INTEGER) IS NOT NULL AND TRY_CAST(f[3] AS DOUBLE) IS NOT NULL
  AND TRY_CAST(f[4] AS INTEGER) IS NOT NULL"""


LOAD_RATINGS_SQL = fx.with_views("rating_lines", """parsed AS (
  SELECT string_split(regexp_replace(value, '(?:,)+$', ''), ',') AS f FROM rating_lines)""") + f"""
SELECT {_RATING_CASTS} FROM parsed WHERE {_ALL_CAST}
"""


@register("load_ratings", LOAD_RATINGS_SQL)
def _load_ratings(spark, d):
    good, _ = text.split_good_bad(text.parse_rating_lines(fx.rating_lines(spark, d)),
                                  RATING.fieldNames())
    return good


@register("load_ratings_csv", LOAD_RATINGS_SQL)
def _load_ratings_csv(spark, d):
    """The rating file with every second field in quotes, through the CSV reader."""
    path = scratch_path(spark, "ratings-csv")
    parts = F.split("value", ",")
    quoted = F.transform(parts, lambda x, i: F.when(i % 2 == 1, F.concat(F.lit('"'), x, F.lit('"'))).otherwise(x))
    fx.rating_lines(spark, d).select(F.array_join(quoted, ",").alias("value")).write.text(path)
    good, _ = text.read_ratings_text(spark, path, quoted=True)
    return good


def msg_parsed(lines: str) -> str:
    return f"""parsed AS (
  SELECT event_id, value, string_split(regexp_replace(value, '(?:\\|)+$', ''), '|') AS f
  FROM {lines})"""


@register("rating_message_parse", fx.with_views("rating_message_lines", msg_parsed("rating_message_lines")) + f"""
SELECT event_id, {_RATING_CASTS} FROM parsed WHERE {_ALL_CAST}
""")
def _rating_message_parse(spark, d):
    good, _ = text.split_good_bad(text.parse_rating_messages(fx.message_lines(spark, d)),
                                  RATING.fieldNames(), keys=["event_id"])
    return good


@register("rating_message_quarantine", fx.with_views("rating_message_lines", msg_parsed("rating_message_lines")) + f"""
SELECT event_id, value, CASE WHEN len(f) < 4 THEN 'short_row' ELSE 'bad_value' END AS reason
FROM parsed WHERE NOT ({_ALL_CAST})
""")
def _rating_message_quarantine(spark, d):
    _, bad = text.split_good_bad(text.parse_rating_messages(fx.message_lines(spark, d)),
                                 RATING.fieldNames(), keys=["event_id"])
    return bad


LOG_FILTER_SQL = fx.with_views("log_lines") + f"""
SELECT event_id, value FROM (
  SELECT event_id,
         nullif({_trim("string_split(value, 'PRODUCT_RATING_PREFIX:')[2]")}, '') AS value
  FROM log_lines WHERE contains(value, 'PRODUCT_RATING_PREFIX:'))
WHERE value IS NOT NULL
"""


@register("log_rating_filter", LOG_FILTER_SQL)
def _log_rating_filter(spark, d):
    return text.extract_rating_payloads(fx.log_lines(spark, d))


@register("ratings_scan", fx.with_views("ratings") + """
SELECT userId, productId, score FROM ratings
""")
def _ratings_scan(spark, d):
    return tables.as_ratings(fx.ratings(spark, d)).select("userId", "productId", "score")


@register("products_scan", fx.with_views("products") + """
SELECT productId, name, imageUrl, categories, tags FROM products
""")
def _products_scan(spark, d):
    return fx.products(spark, d).select(*PRODUCT.fieldNames())


@register("write_read_roundtrip", fx.with_views("ratings") + """
SELECT userId, productId, score, "timestamp" FROM ratings
""")
def _write_read_roundtrip(spark, d):
    """Replace the Product and Rating tables, then scan Rating back typed."""
    base = scratch_path(spark, "tables")
    tables.write_table(fx.products(spark, d).select(*PRODUCT.fieldNames()), f"{base}/Product")
    tables.write_table(tables.as_ratings(fx.ratings(spark, d)), f"{base}/Rating")
    return tables.read_ratings(spark, f"{base}/Rating")
