"""Statistics and co-rating queries over the fixture views."""

from __future__ import annotations

from pyspark.sql import functions as F

from rateflow.functions.exprs import round6
from rateflow.functions.sql import register_sql_functions
from rateflow.operators import itemcf, stats
from rateflow.operators.topk import flatten
from rateflow.plans.registry import register
from rateflow.sources import fixtures as fx

# ---------------------------------------------------------------- statistics

register("rate_more_products", fx.with_views("ratings_orders") + """
SELECT productId, count(productId) AS count FROM ratings_orders GROUP BY productId
""")(lambda spark, d: stats.rate_more_products(fx.ratings_orders(spark, d)))

_RECENTLY_SQL = fx.with_views("ratings_orders") + """
SELECT productId, count(productId) AS count,
       CAST(year(make_timestamp(CAST("timestamp" AS BIGINT) * 1000000)) * 100
            + month(make_timestamp(CAST("timestamp" AS BIGINT) * 1000000)) AS INTEGER) AS yearmonth
FROM ratings_orders GROUP BY yearmonth, productId
"""

register("rate_more_recently_products", _RECENTLY_SQL)(
    lambda spark, d: stats.rate_more_recently_products(fx.ratings_orders(spark, d)))


@register("rate_more_recently_products_sql", _RECENTLY_SQL)
def _rate_more_recently_products_sql(spark, d):
    """Same statistic through the SQL surface: temp views + changeDate SQL function."""
    fx.register_views(spark, d)
    register_sql_functions(spark)
    return spark.sql("""
        FROM rateflow_ratings_orders
        |> SELECT productId, changeDate(`timestamp`) AS yearmonth
        |> AGGREGATE count(*) AS count GROUP BY productId, yearmonth
        |> SELECT productId, count, yearmonth
        |> ORDER BY yearmonth DESC, count DESC, productId""")


@register("average_products", fx.with_views("ratings_orders") + """
SELECT productId, round(avg(score), 6) AS avg FROM ratings_orders GROUP BY productId
""")
def _average_products(spark, d):
    a = stats.average_products(fx.ratings_orders(spark, d))
    return a.select("productId", round6("avg").alias("avg"))


register("rating_year_month", fx.with_views("ratings_orders") + """
SELECT productId, score,
       CAST(strftime(make_timestamp(CAST("timestamp" AS BIGINT) * 1000000), '%Y%m') AS INTEGER)
         AS yearmonth
FROM ratings_orders
""")(lambda spark, d: stats.rating_year_month(fx.ratings_orders(spark, d)))

register("distinct_users", fx.with_views("ratings_orders") + """
SELECT DISTINCT userId FROM ratings_orders
""")(lambda spark, d: stats.distinct_users(fx.ratings_orders(spark, d)))

register("distinct_products", fx.with_views("ratings_orders") + """
SELECT DISTINCT productId FROM ratings_orders
""")(lambda spark, d: stats.distinct_products(fx.ratings_orders(spark, d)))

# ------------------------------------------------------------------ co-rating

register("itemcf_rating_counts", fx.with_views("ratings") + """
SELECT productId, count(*) AS count FROM ratings GROUP BY productId
""")(lambda spark, d: itemcf.rating_counts(fx.ratings(spark, d)))

register("itemcf_rating_with_count", fx.with_views("ratings") + """
SELECT r.productId, r.userId, r.score, c.count
FROM ratings r JOIN (SELECT productId, count(*) AS count FROM ratings GROUP BY productId) c
  ON r.productId = c.productId
""")(lambda spark, d: itemcf.rating_with_count(fx.ratings(spark, d)))

COUNTS_SQL = "c AS (SELECT productId, count(*) AS n FROM ratings GROUP BY productId)"
PAIRS_SQL = """pairs AS (
  SELECT a.productId AS product1, b.productId AS product2, count(*) AS cocount
  FROM ratings a JOIN ratings b ON a.userId = b.userId
  GROUP BY 1, 2)"""
_SIMS = """sims AS (
  SELECT p.product1, p.product2,
         p.cocount / sqrt(CAST(c1.n AS DOUBLE) * CAST(c2.n AS DOUBLE)) AS sim
  FROM pairs p JOIN c c1 ON p.product1 = c1.productId JOIN c c2 ON p.product2 = c2.productId
  WHERE p.product1 <> p.product2)"""
_TOP10 = """top AS (
  SELECT product1 AS productId, product2 AS simProductId, sim,
         CAST(row_number() OVER (PARTITION BY product1
                                 ORDER BY round(sim, 9) DESC, product2 ASC) AS INTEGER) AS rank
  FROM sims
  QUALIFY rank <= 10)"""

COOCCURRENCE_SQL = """
SELECT p.product1, p.product2, p.cocount, c1.n AS count1, c2.n AS count2
FROM pairs p JOIN c c1 ON p.product1 = c1.productId JOIN c c2 ON p.product2 = c2.productId
"""
register("itemcf_cooccurrence", fx.with_views("ratings", COUNTS_SQL, PAIRS_SQL) + COOCCURRENCE_SQL)(lambda spark, d: itemcf.cooccurrence(fx.ratings(spark, d)))


@register("itemcf_similarity", fx.with_views("ratings", COUNTS_SQL, PAIRS_SQL, _SIMS) + """
SELECT product1, product2, round(sim, 6) AS sim FROM sims
""")
def _itemcf_similarity(spark, d):
    s = itemcf.similarity(fx.ratings(spark, d))
    return s.select("product1", "product2", round6("sim").alias("sim"))


@register("itemcf_similarity_dedup", fx.with_views("ratings", """d AS (
  SELECT DISTINCT userId, productId FROM ratings)""", """dc AS (
  SELECT productId, count(*) AS n FROM d GROUP BY productId)""", """dp AS (
  SELECT a.productId AS product1, b.productId AS product2, count(*) AS co
  FROM d a JOIN d b ON a.userId = b.userId AND a.productId <> b.productId
  GROUP BY 1, 2)""") + """
SELECT p.product1, p.product2,
       round(p.co / sqrt(CAST(c1.n AS DOUBLE) * CAST(c2.n AS DOUBLE)), 6) AS sim
FROM dp p JOIN dc c1 ON p.product1 = c1.productId JOIN dc c2 ON p.product2 = c2.productId
""")
def _itemcf_similarity_dedup(spark, d):
    """Ledger option: each (user, product) counted once, so sim <= 1."""
    s = itemcf.similarity(fx.ratings(spark, d), dedup=True)
    return s.select("product1", "product2", round6("sim").alias("sim"))


@register("itemcf_similarity_top10",
          fx.with_views("ratings", COUNTS_SQL, PAIRS_SQL, _SIMS, _TOP10) + """
SELECT productId, rank, simProductId, round(sim, 6) AS score FROM top
""")
def _itemcf_top10(spark, d):
    t = itemcf.top_neighbours(fx.ratings(spark, d))
    return t.select("productId", "rank", "simProductId", round6("score").alias("score"))


@register("itemcf_similarity_top10_wide", fx.with_views(
    "wide_ratings", *(x.replace("FROM ratings", "FROM wide_ratings").replace("JOIN ratings", "JOIN wide_ratings")
                      for x in (COUNTS_SQL, PAIRS_SQL, _SIMS, _TOP10))) + """
SELECT productId, rank, simProductId, round(sim, 6) AS score FROM top
""")
def _itemcf_top10_wide(spark, d):
    """Over all order products, with a user whose group is split into blocks."""
    t = itemcf.top_neighbours(fx.wide_ratings(spark, d))
    return t.select("productId", "rank", "simProductId", round6("score").alias("score"))


@register("itemcf_product_recs",
          fx.with_views("ratings", COUNTS_SQL, PAIRS_SQL, _SIMS, _TOP10) + """
SELECT c.productId,
       coalesce(list(t.simProductId ORDER BY t.rank) FILTER (WHERE t.simProductId IS NOT NULL),
                CAST([] AS INTEGER[])) AS recProductIds,
       coalesce(list(round(t.sim, 6) ORDER BY t.rank) FILTER (WHERE t.simProductId IS NOT NULL),
                CAST([] AS DOUBLE[])) AS recScores
FROM c LEFT JOIN top t ON c.productId = t.productId
GROUP BY c.productId
""")
def _itemcf_product_recs(spark, d):
    """Nested lists (empty for lone products), shown as two aligned arrays --
    neighbour ids and scores in rank order -- so that engines compare them
    as plain values."""
    r = itemcf.product_recs(fx.ratings(spark, d))
    return r.select("productId",
                    F.transform("recs", lambda e: e["productId"]).alias("recProductIds"),
                    F.transform("recs", lambda e: F.round(e["score"], 6)).alias("recScores"))


@register("similarity_flatten",
          fx.with_views("ratings", COUNTS_SQL, PAIRS_SQL, _SIMS, _TOP10) + """
SELECT productId, simProductId, round(sim, 6) AS score FROM top
""")
def _similarity_flatten(spark, d):
    nested = itemcf.product_recs(fx.ratings(spark, d))
    flat = flatten(nested, "productId")
    return flat.select("productId", "simProductId", round6("score").alias("score"))
