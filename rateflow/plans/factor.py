"""Factor-model queries: split, RMSE, per-user top-k, ALS fits and the grid."""

from __future__ import annotations

from pyspark.sql import functions as F

from rateflow.functions.exprs import rank_key, round6
from rateflow.operators import als
from rateflow.operators import normal_equations as ne
from rateflow.operators.topk import top_k_per_group
from rateflow.plans.registry import register
from rateflow.sources import fixtures as fx

SPLIT_SQL = """split AS (
  SELECT userId, productId, score, "timestamp",
         CASE WHEN (CAST(userId AS BIGINT) * 31 + CAST(productId AS BIGINT) * 17
                    + "timestamp") % 10 < 8 THEN 'train' ELSE 'test' END AS split
  FROM ratings_orders),
means AS (SELECT productId, avg(score) AS pred FROM split WHERE split = 'train'
          GROUP BY productId)"""


def _split(spark, d):
    return als.arithmetic_split(fx.ratings_orders(spark, d))


def _train_means(s):
    return (s.where(F.col("split") == "train").groupBy("productId")
            .agg(F.avg("score").alias("prediction")))


register("train_test_split", fx.with_views("ratings_orders", SPLIT_SQL) + """
SELECT userId, productId, score, "timestamp", split FROM split
""")(_split)


@register("prediction_rmse", fx.with_views("ratings_orders", SPLIT_SQL) + """
SELECT round(sqrt(avg((t.score - m.pred) * (t.score - m.pred))), 6) AS rmse, count(*) AS n
FROM split t JOIN means m ON t.productId = m.productId
WHERE t.split = 'test'
""")
def _prediction_rmse(spark, d):
    s = _split(spark, d)
    r = als.rmse(s.where(F.col("split") == "test").join(_train_means(s), "productId"))
    return r.select(round6("rmse").alias("rmse"), "n")


@register("top_k_per_user", fx.with_views("ratings_orders", SPLIT_SQL) + """
SELECT userId, rank, productId, round(score, 6) AS score FROM (
  SELECT p.userId, p.productId, m.pred AS score,
         CAST(row_number() OVER (PARTITION BY p.userId
              ORDER BY round(m.pred, 9) DESC, p.productId) AS INTEGER) AS rank
  FROM (SELECT DISTINCT userId, productId FROM split) p
  JOIN means m ON p.productId = m.productId
  WHERE m.pred > 0)
WHERE rank <= 20
""")
def _top_k_per_user(spark, d):
    """Every rated pair scored with the product's training mean; products never seen in
    training fall out."""
    s = _split(spark, d)
    p = (s.select("userId", "productId").distinct().join(_train_means(s), "productId")
         .where(F.col("prediction") > 0))
    t = top_k_per_group(p, ["userId"], [rank_key("prediction").desc(), F.col("productId")], 20)
    return t.select("userId", "rank", "productId", round6("prediction").alias("score"))


def _model(spark, d):
    return als.fit(fx.ratings_orders(spark, d))


@register("als_factors")
def _als_factors(spark, d):
    return als.item_factors(_model(spark, d))


@register("als_predict")
def _als_predict(spark, d):
    s = _split(spark, d)
    model = als.fit(s.where(F.col("split") == "train"))
    return als.predict(model, s.where(F.col("split") == "test")
                       .select("userId", "productId", "score"))


@register("als_user_recs")
def _als_user_recs(spark, d):
    return als.user_recs(_model(spark, d))


@register("als_product_recs")
def _als_product_recs(spark, d):
    """Every similar product of every product."""
    return als.product_recs(_model(spark, d))


# Neighbours per product in the short lists.
PRODUCT_TOP = 20


@register("als_product_top20")
def _als_product_top20(spark, d):
    """The same lists cut to the most similar products, of which no more than these leave a task."""
    return als.product_recs(_model(spark, d), k=PRODUCT_TOP)


@register("factor_user_recs", fx.with_views("item_vectors", """v AS (
  SELECT productId AS id, CAST(features AS DOUBLE[]) AS f FROM item_vectors)""", """dots AS (
  SELECT u.id AS userId, i.id AS productId, list_dot_product(u.f, i.f) AS score FROM v u, v i)""") + f"""
SELECT userId, rank, productId, round(score, 6) AS score FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY userId ORDER BY round(score, 9) DESC, productId) AS INTEGER) AS rank
  FROM dots WHERE round(score, 9) > 0)
WHERE rank <= {als.USER_RECS}
""")
def _factor_user_recs(spark, d):
    """The factor model's prediction and per-user list over given vectors: the
    embeddings stand for the factors of users and of products."""
    v = fx.item_vectors(spark, d)
    t = als.top_products(v.withColumnRenamed("productId", "userId"), v)
    return t.select("userId", "rank", "productId", round6("score").alias("score"))


def _grid(spark, d):
    s = _split(spark, d)
    return als.grid(spark, s.where(F.col("split") == "train"),
                    s.where(F.col("split") == "test"))


register("als_grid")(_grid)
register("als_best_params")(lambda spark, d: als.best_params(_grid(spark, d)))


# ---- least squares with given vectors: everything that a fit alternates, checked by SQL ----

VECTOR_RANKS = (2, 3, 5)


def _solved(name: str, source: str, key: str, other: str, factors: str, rank: int, reg: float) -> str:
    """CTEs ``name`` (key, n, x0, x1, ...): each key's ridge system, by elimination without pivots.

    ``source`` has (userId, productId, score), ``factors`` (other, f as a list).
    """
    upper = [(i, j) for i in range(rank) for j in range(i, rank)]
    sums = [f"sum(v.f[{i + 1}] * v.f[{j + 1}]) + CASE WHEN {i} = {j} THEN {reg} * count(*) ELSE 0 END AS a0_{i}_{j}" for i, j in upper]
    sums += [f"sum(r.score * v.f[{i + 1}]) AS b0_{i}" for i in range(rank)]
    text = f"SELECT r.{key}, count(*) AS n, {', '.join(sums)} FROM {source} r JOIN {factors} v ON r.{other} = v.{other} GROUP BY r.{key}"
    for k in range(rank - 1):
        new = [f"a{k}_{i}_{j} - a{k}_{k}_{i} * a{k}_{k}_{j} / a{k}_{k}_{k} AS a{k + 1}_{i}_{j}" for i, j in upper if i > k]
        new += [f"b{k}_{i} - a{k}_{k}_{i} * b{k}_{k} / a{k}_{k}_{k} AS b{k + 1}_{i}" for i in range(k + 1, rank)]
        text = f"SELECT *, {', '.join(new)} FROM ({text})"
    for i in reversed(range(rank)):
        rest = "".join(f" - a{i}_{i}_{j} * x{j}" for j in range(i + 1, rank))
        text = f"SELECT *, (b{i}_{i}{rest}) / a{i}_{i}_{i} AS x{i} FROM ({text})"
    xs = ", ".join(f"x{i}" for i in range(rank))
    return f"{name} AS (SELECT {key}, n, {xs}, [{xs}] AS f FROM ({text}))"


def _factor_rows(df, key: str):
    """(key, position, value) of factor vectors."""
    return df.select(key, F.posexplode("features").alias("position", "value")).select(key, "position", round6("value").alias("value"))


_UNNESTED = """
SELECT {key}, CAST(generate_subscripts(f, 1) - 1 AS INTEGER) AS position, round(unnest(f), 6) AS value FROM {name}
"""


@register("als_normal_equations", fx.with_views(
    ["ratings_orders", "product_vectors"], _solved("users", "ratings_orders", "userId", "productId", "product_vectors", als.RANK, als.REG))
    + _UNNESTED.format(key="userId", name="users"))
def _als_normal_equations(spark, d):
    """Users' factors by least squares, for given vectors as product factors."""
    return _factor_rows(ne.half_step(fx.ratings_orders(spark, d), fx.product_vectors(spark, d), "userId", "productId", als.REG), "userId")


@register("als_sweep", fx.with_views(
    ["ratings_orders", "product_vectors"], _solved("users", "ratings_orders", "userId", "productId", "product_vectors", als.RANK, als.REG),
    _solved("items", "ratings_orders", "productId", "userId", "users", als.RANK, als.REG)) + _UNNESTED.format(key="productId", name="items"))
def _als_sweep(spark, d):
    """One whole iteration of the fit: given product vectors to users' factors to products' factors."""
    r = fx.ratings_orders(spark, d)
    users = ne.half_step(r, fx.product_vectors(spark, d), "userId", "productId", als.REG).checkpoint()
    return _factor_rows(ne.half_step(r, users, "productId", "userId", als.REG), "productId")


def _dot(rank: int) -> str:
    return " + ".join(f"u.x{i} * v.f[{i + 1}]" for i in range(rank))


_TRAIN = "train AS (SELECT * FROM split WHERE split = 'train')"


@register("als_fold_in_predictions", fx.with_views(
    ["ratings_orders", "product_vectors"], SPLIT_SQL, _TRAIN,
    _solved("users", "train", "userId", "productId", "product_vectors", als.RANK, als.REG)) + f"""
SELECT t.userId, t.productId, t."timestamp", t.score, round({_dot(als.RANK)}, 6) AS prediction
FROM split t JOIN users u ON t.userId = u.userId JOIN product_vectors v ON t.productId = v.productId WHERE t.split = 'test'
""")
def _als_fold_in_predictions(spark, d):
    """Users folded in by their training ratings; predictions for their held-out ones."""
    items = fx.product_vectors(spark, d)
    s = _split(spark, d)
    users = ne.fold_in(s.where(F.col("split") == "train"), items, als.REG)
    return (ne.predict(s.where(F.col("split") == "test"), users, items)
            .select("userId", "productId", "timestamp", "score", round6("prediction").alias("prediction")))


_GRID = [(rank, reg) for rank in VECTOR_RANKS for reg in als.GRID_REGS]
_GRID_SQL = fx.with_views(
    ["ratings_orders", "product_vectors"], SPLIT_SQL, _TRAIN,
    *[_solved(f"u{n}", "train", "userId", "productId", "product_vectors", *point) for n, point in enumerate(_GRID)],
    "points AS (" + " UNION ALL ".join(f"""
  SELECT CAST({rank} AS INTEGER) AS rank, CAST({reg} AS DOUBLE) AS regParam,
         sqrt(avg((t.score - ({_dot(rank)})) * (t.score - ({_dot(rank)})))) AS rmse
  FROM split t JOIN u{n} u ON t.userId = u.userId JOIN product_vectors v ON t.productId = v.productId
  WHERE t.split = 'test'""" for n, (rank, reg) in enumerate(_GRID)) + ")")


def _vector_grid(spark, d):
    s = _split(spark, d)
    return ne.holdout_grid(s.where(F.col("split") == "train"), s.where(F.col("split") == "test"),
                           fx.product_vectors(spark, d, max(VECTOR_RANKS)), VECTOR_RANKS, als.GRID_REGS)


@register("factor_grid", _GRID_SQL + "SELECT rank, regParam, round(rmse, 6) AS rmse FROM points")
def _factor_grid(spark, d):
    """Held-out error of every rank and ridge, for given vectors as product factors."""
    return _vector_grid(spark, d).select("rank", "regParam", round6("rmse").alias("rmse"))


@register("factor_best_params", _GRID_SQL + """
SELECT rank, regParam, round(rmse, 6) AS rmse FROM points ORDER BY round(points.rmse, 9), rank, regParam LIMIT 1""")
def _factor_best_params(spark, d):
    return als.best_params(_vector_grid(spark, d)).select("rank", "regParam", round6("rmse").alias("rmse"))
