"""Views over the test tables that stand in for the rating system's inputs.

Each view exists twice: as a Spark DataFrame builder and as a DuckDB common
table expression with the same meaning, so that every oracle query can be
written against the same names.  See FIXTURES.md for the definitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rateflow.functions.exprs import epoch_seconds

# Fixed split of the events table into stored history and the message stream.
MESSAGE_BUCKET = 9          # event_id % 10 == 9 -> message, else history
STREAM_SPLIT_TS = "2024-01-16 00:00:00"   # first / second micro-batch of messages


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --------------------------------------------------------------------------
# Spark builders
# --------------------------------------------------------------------------

def ratings(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """Every event as a rating, with its id and ``more`` columns of the table."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").cast("int").alias("userId"),
        F.get_json_object("props", "$.k").cast("int").alias("productId"),
        (F.lit(1) + F.floor("value").cast("bigint") % 5).cast("double").alias("score"),
        epoch_seconds("ts").alias("timestamp"),
        F.col("event_id"), *more,
    )


def ratings_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(od, li.l_orderkey == od.o_orderkey)
    return j.select(
        F.col("o_custkey").cast("int").alias("userId"),
        F.col("l_partkey").cast("int").alias("productId"),
        (F.lit(1) + (F.col("l_quantity").cast("bigint") - 1) % 5).cast("double").alias("score"),
        epoch_seconds("o_orderdate").alias("timestamp"),
    )


def wide_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order ratings, and one user (id 0) who rated every product."""
    hot = products(spark, sf_dir).select(F.lit(0).alias("userId"), "productId", F.lit(3.0).alias("score"),
                                         F.lit(0).alias("timestamp"))
    return ratings_orders(spark, sf_dir).unionByName(hot)


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ratings(spark, sf_dir).where(F.col("event_id") % 10 != MESSAGE_BUCKET)


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ratings(spark, sf_dir).where(F.col("event_id") % 10 == MESSAGE_BUCKET)


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").cast("int").alias("productId"),
        F.col("p_name").alias("name"),
        F.lit("").alias("imageUrl"),
        F.col("p_type").alias("categories"),
        F.concat(F.replace("p_name", F.lit(" "), F.lit("|")), F.lit("|"),
                 F.col("p_type"), F.lit("|"), F.col("p_brand")).alias("tags"),
    )


def content_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").cast("int").alias("productId"),
                    F.col("text").alias("tags"))


def product_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products as '^'-separated text with planted bad rows."""
    p = products(spark, sf_dir)
    pid = F.col("productId").cast("string")
    k = F.col("productId") % 50
    name = F.when(k == 3, F.concat(F.lit(" \t"), "name", F.lit("\t "))).otherwise(F.col("name"))
    good = F.concat_ws("^", pid, name, F.lit("1,2"), F.lit("B000"), "imageUrl", "categories", "tags")
    line = (F.when(k == 7, F.concat_ws("^", pid, "name", F.lit("x")))
            .when(k == 13, F.concat_ws("^", F.concat(F.lit("p"), pid), "name", F.lit("1,2"),
                                       F.lit("B000"), "imageUrl", "categories", "tags"))
            .when(k == 21, F.concat_ws("^", pid, "name", F.lit("1,2"), F.lit("B000"),
                                       "imageUrl", "categories", F.lit("")))
            .otherwise(good))
    return p.select(F.col("productId").alias("line_id"), line.alias("value"))


def rating_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings as comma text with planted bad rows."""
    r = ratings(spark, sf_dir)
    k = F.col("event_id") % 97
    u, p, s, t = (F.col(c).cast("string") for c in ("userId", "productId", "score", "timestamp"))
    line = (F.when(k == 5, F.concat_ws(",", u, p, s))
            .when(k == 11, F.concat_ws(",", F.concat(F.lit("u"), u), p, s, t))
            .otherwise(F.concat_ws(",", u, p, s, t)))
    return r.select(F.col("event_id").alias("line_id"), line.alias("value"))


def message_lines(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
    """Ratings (all of them, or ``rows``) as 'userId|productId|score|timestamp' with
    planted bad rows."""
    m = ratings(spark, sf_dir) if rows is None else rows
    u, p, s, t = (F.col(c).cast("string") for c in ("userId", "productId", "score", "timestamp"))
    line = (F.when(F.col("event_id") % 7 == 2, F.concat_ws("|", u, p))
            .when(F.col("event_id") % 13 == 5, F.concat_ws("|", u, p, F.lit("abc"), t))
            .otherwise(F.concat_ws("|", u, p, s, t)))
    return m.select("event_id", line.alias("value"))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One log line per event; errors carry no rating prefix."""
    m = ratings(spark, sf_dir, "event_type")
    u, p, s, t = (F.col(c).cast("string") for c in ("userId", "productId", "score", "timestamp"))
    msg = F.concat_ws("|", u, p, s, t)
    pad = F.when(F.col("event_id") % 3 == 0, F.lit("\t\t")).otherwise(F.lit(""))
    line = (F.when(F.col("event_type") == "error", F.concat(t, F.lit(" ERROR "), msg))
            .otherwise(F.concat(t, F.lit(" INFO PRODUCT_RATING_PREFIX:"), msg, pad)))
    return m.select("event_id", line.alias("value"))


def item_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").cast("int").alias("productId"),
                    F.col("embedding").alias("features"))


def product_vectors(spark: SparkSession, sf_dir: str, rank: int = 5) -> DataFrame:
    """Given factors for every product: the first numbers of the vector that its id falls on."""
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("int").alias("productId"))
    return (p.withColumn("vec_id", p.productId % F.lit(e.count())).join(e, "vec_id")
            .select("productId", F.slice("embedding", 1, rank).cast("array<double>").alias("features")))


def similarities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Co-occurrence similarity over history, > 0.6, no self pairs, both orders."""
    from rateflow.operators.itemcf import similarity_above
    return similarity_above(history(spark, sf_dir), 0.6)


def register_views(spark: SparkSession, sf_dir: str, prefix: str = "rateflow_") -> list[str]:
    """Register the main views as temp views ``<prefix><name>`` for ad-hoc SQL."""
    builders = {"ratings": ratings, "ratings_orders": ratings_orders, "history": history,
                "messages": messages, "products": products, "content_items": content_items}
    for name, build in builders.items():
        build(spark, sf_dir).createOrReplaceTempView(prefix + name)
    return [prefix + n for n in builders]


# --------------------------------------------------------------------------
# DuckDB text of the same views
# --------------------------------------------------------------------------

_SQL = {
    "ratings": """
  SELECT CAST(user_id AS INTEGER) AS userId,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS productId,
         CAST(1 + CAST(floor(value) AS BIGINT) % 5 AS DOUBLE) AS score,
         CAST(floor(epoch(ts)) AS INTEGER) AS "timestamp",
         event_id
  FROM events""",
    "ratings_orders": """
  SELECT CAST(o.o_custkey AS INTEGER) AS userId,
         CAST(l.l_partkey AS INTEGER) AS productId,
         CAST(1 + (CAST(trunc(l.l_quantity) AS BIGINT) - 1) % 5 AS DOUBLE) AS score,
         CAST(floor(epoch(o.o_orderdate)) AS INTEGER) AS "timestamp"
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "wide_ratings": """
  SELECT userId, productId FROM ratings_orders UNION ALL SELECT 0, productId FROM products""",
    "history": """
  SELECT * FROM ratings WHERE event_id % 10 <> 9""",
    "messages": """
  SELECT * FROM ratings WHERE event_id % 10 = 9""",
    "products": """
  SELECT CAST(p_partkey AS INTEGER) AS productId, p_name AS name, '' AS imageUrl,
         p_type AS categories,
         replace(p_name, ' ', '|') || '|' || p_type || '|' || p_brand AS tags
  FROM part""",
    "content_items": """
  SELECT CAST(doc_id AS INTEGER) AS productId, text AS tags FROM documents""",
    "product_lines": """
  SELECT productId AS line_id,
    CASE productId % 50
      WHEN 7 THEN concat_ws('^', CAST(productId AS VARCHAR), name, 'x')
      WHEN 13 THEN concat_ws('^', 'p' || CAST(productId AS VARCHAR), name, '1,2', 'B000',
                             imageUrl, categories, tags)
      WHEN 21 THEN concat_ws('^', CAST(productId AS VARCHAR), name, '1,2', 'B000',
                             imageUrl, categories, '')
      ELSE concat_ws('^', CAST(productId AS VARCHAR),
                     CASE WHEN productId % 50 = 3 THEN ' ' || chr(9) || name || chr(9) || ' '
                          ELSE name END,
                     '1,2', 'B000', imageUrl, categories, tags)
    END AS value
  FROM products""",
    "rating_lines": """
  SELECT event_id AS line_id,
    CASE event_id % 97
      WHEN 5 THEN concat_ws(',', CAST(userId AS VARCHAR), CAST(productId AS VARCHAR),
                            CAST(score AS VARCHAR))
      WHEN 11 THEN concat_ws(',', 'u' || CAST(userId AS VARCHAR), CAST(productId AS VARCHAR),
                             CAST(score AS VARCHAR), CAST("timestamp" AS VARCHAR))
      ELSE concat_ws(',', CAST(userId AS VARCHAR), CAST(productId AS VARCHAR),
                     CAST(score AS VARCHAR), CAST("timestamp" AS VARCHAR))
    END AS value
  FROM ratings""",
    "message_lines": """
  SELECT event_id, value FROM rating_message_lines WHERE event_id % 10 = 9""",
    "rating_message_lines": """
  SELECT event_id,
    CASE WHEN event_id % 7 = 2 THEN concat_ws('|', CAST(userId AS VARCHAR), CAST(productId AS VARCHAR))
         WHEN event_id % 13 = 5 THEN concat_ws('|', CAST(userId AS VARCHAR), CAST(productId AS VARCHAR),
                                               'abc', CAST("timestamp" AS VARCHAR))
         ELSE concat_ws('|', CAST(userId AS VARCHAR), CAST(productId AS VARCHAR),
                        CAST(score AS VARCHAR), CAST("timestamp" AS VARCHAR))
    END AS value
  FROM ratings""",
    "log_lines": """
  SELECT m.event_id,
    CASE WHEN e.event_type = 'error'
         THEN CAST(m."timestamp" AS VARCHAR) || ' ERROR ' ||
              concat_ws('|', CAST(m.userId AS VARCHAR), CAST(m.productId AS VARCHAR),
                        CAST(m.score AS VARCHAR), CAST(m."timestamp" AS VARCHAR))
         ELSE CAST(m."timestamp" AS VARCHAR) || ' INFO PRODUCT_RATING_PREFIX:' ||
              concat_ws('|', CAST(m.userId AS VARCHAR), CAST(m.productId AS VARCHAR),
                        CAST(m.score AS VARCHAR), CAST(m."timestamp" AS VARCHAR)) ||
              CASE WHEN m.event_id % 3 = 0 THEN chr(9) || chr(9) ELSE '' END
    END AS value
  FROM ratings m JOIN events e ON m.event_id = e.event_id""",
    "hist_counts": """
  SELECT productId, count(*) AS n FROM history GROUP BY productId""",
    "hist_pairs": """
  SELECT a.productId AS p1, b.productId AS p2, count(*) AS co
  FROM history a JOIN history b ON a.userId = b.userId AND a.productId <> b.productId
  GROUP BY 1, 2""",
    "similarities": """
  SELECT pr.p1 AS productId, pr.p2 AS simProductId,
         pr.co / sqrt(CAST(c1.n AS DOUBLE) * CAST(c2.n AS DOUBLE)) AS sim
  FROM hist_pairs pr JOIN hist_counts c1 ON pr.p1 = c1.productId
                     JOIN hist_counts c2 ON pr.p2 = c2.productId
  WHERE round(pr.co / sqrt(CAST(c1.n AS DOUBLE) * CAST(c2.n AS DOUBLE)), 9) > 0.6""",
    "product_vectors": """
  SELECT CAST(p.p_partkey AS INTEGER) AS productId, CAST(e.embedding AS DOUBLE[]) AS f
  FROM part p JOIN embeddings e ON e.vec_id = p.p_partkey % (SELECT count(*) FROM embeddings)""",
    "item_vectors": """
  SELECT CAST(vec_id AS INTEGER) AS productId, embedding AS features FROM embeddings""",
}

_DEPS = {
    "wide_ratings": ["ratings_orders", "products"],
    "history": ["ratings"],
    "messages": ["ratings"],
    "product_lines": ["products"],
    "rating_lines": ["ratings"],
    "rating_message_lines": ["ratings"],
    "message_lines": ["ratings", "rating_message_lines"],
    "log_lines": ["ratings"],
    "hist_counts": ["ratings", "history"],
    "hist_pairs": ["ratings", "history"],
    "similarities": ["ratings", "history", "hist_counts", "hist_pairs"],
}


def sql_views(*names: str) -> list[str]:
    """CTE clauses ``name AS (...)`` for the named views and what they use."""
    order: list[str] = []

    def add(n):
        for d in _DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    return [f"{n} AS ({_SQL[n]}\n)" for n in order]


def with_views(names, *extra_ctes: str) -> str:
    """A WITH clause holding the fixture views plus extra CTEs."""
    if isinstance(names, str):
        names = [names]
    parts = sql_views(*names) + list(extra_ctes)
    return "WITH " + ",\n".join(parts) + "\n"
