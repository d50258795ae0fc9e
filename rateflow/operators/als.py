"""Latent-factor model: Spark ML ALS, per-user top-k and item similarity from the
factors (in blocks, without a cross join), a seeded or arithmetic train/test split, RMSE and a parameter grid."""

from __future__ import annotations

import gc
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rateflow.functions.exprs import MIN_STORED_SIM, USER_RECS, rank_key
from rateflow.operators import normal_equations
from rateflow.operators.dense import best_per_block, ranked_above, top_by_norm
from rateflow.operators.topk import nest, top_k_per_group
from rateflow.session import shared_dir

# Fixed values of the original job.
RANK, MAX_ITER, REG = 5, 10, 0.01
GRID_RANKS = (5, 10, 20, 50)
GRID_REGS = (1.0, 0.1, 0.01)
SEED = 42


def als(rank: int = RANK, max_iter: int = MAX_ITER, reg: float = REG, seed: int = SEED) -> ALS:
    return ALS(rank=rank, maxIter=max_iter, regParam=reg, seed=seed,
               userCol="userId", itemCol="productId", ratingCol="score",
               coldStartStrategy="drop",
               checkpointInterval=1)    # what an iteration shuffled goes with the next checkpoint


def fit(ratings: DataFrame, rank: int = RANK, max_iter: int = MAX_ITER, reg: float = REG,
        seed: int = SEED) -> ALSModel:
    shared_dir(ratings.sparkSession)   # ALS checkpoints its factor lineage there
    return als(rank, max_iter, reg, seed).fit(ratings.select("userId", "productId", "score"))


def item_factors(model: ALSModel) -> DataFrame:
    return model.itemFactors.select(F.col("id").alias("productId"), "features")


def predict(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """Scores for (userId, productId) pairs; pairs with an unknown id give no row."""
    return model.transform(pairs).withColumn("prediction", F.col("prediction").cast("double"))


def user_factors(model: ALSModel) -> DataFrame:
    return model.userFactors.select(F.col("id").alias("userId"), "features")


def fold_in(model: ALSModel, new_ratings: DataFrame, reg: float = REG) -> DataFrame:
    """(userId, features) of users from their ratings of the model's products, without a new fit."""
    return normal_equations.fold_in(new_ratings, item_factors(model), reg)


def residuals(model: ALSModel, ratings: DataFrame, reg: float = REG) -> DataFrame:
    """(userId, residual): how far the fit's last step, the users', misses its equations."""
    return normal_equations.residuals(ratings, user_factors(model), item_factors(model), "userId", "productId", reg)


def top_products(users: DataFrame, items: DataFrame, k: int = USER_RECS) -> DataFrame:
    """(userId, rank, productId, score): the k products of the largest positive dot
    product per user, from (userId, features) and (productId, features)."""
    return top_by_norm(users, items, k, "userId", "productId")


def user_recs(model: ALSModel, k: int = USER_RECS) -> DataFrame:
    """(userId, recs): k best products per user, positive scores only; users
    left with nothing are dropped.  Already-rated products are not excluded."""
    top = top_products(user_factors(model), item_factors(model), k)
    return nest(top, "userId", items=(("productId", "productId"), ("score", "score")))


def product_recs(model: ALSModel, threshold: float = MIN_STORED_SIM,
                 k: int | None = None) -> DataFrame:
    """(productId, rank, simProductId, score): item pairs with cosine of their
    factors above the threshold, best first.  With ``k`` only the k best of each
    block leave a task; without it all pairs do, ranked."""
    items = item_factors(model)
    if k is None:
        return ranked_above(items, threshold, "productId", "simProductId")
    others = items.withColumnRenamed("productId", "simProductId")
    best = best_per_block(items, others, k, "productId", "simProductId", above=threshold, unit=True)
    return top_k_per_group(best, ["productId"], [rank_key("score").desc(), F.col("simProductId")], k)


def similarity_table(recs: DataFrame) -> DataFrame:
    """Flat recommendations as the table that scoring reads (``SIMILARITY``)."""
    return recs.select("productId", "simProductId", F.col("score").alias("sim"))


def random_split(ratings: DataFrame, seed: int = SEED) -> list[DataFrame]:
    """[train, test], about 80 to 20.  The rows are written first: a random split
    computed twice over rows in another order would put some on both sides."""
    shared_dir(ratings.sparkSession)
    return ratings.checkpoint().randomSplit([0.8, 0.2], seed)


def arithmetic_split(ratings: DataFrame) -> DataFrame:
    """Adds ``split`` = 'train' for (31*user + 17*product + timestamp) % 10 < 8."""
    h = (F.col("userId").cast("bigint") * 31 + F.col("productId").cast("bigint") * 17
         + F.col("timestamp").cast("bigint")) % 10
    return ratings.withColumn("split", F.when(h < 8, F.lit("train")).otherwise(F.lit("test")))


def rmse(predicted: DataFrame, pred_col: str = "prediction") -> DataFrame:
    """One row (rmse, n) over held-out ratings that carry their prediction."""
    return predicted.agg(F.sqrt(F.avg(F.pow(F.col("score") - F.col(pred_col), 2))).alias("rmse"),
                 F.count(F.lit(1)).alias("n"))


def grid(spark: SparkSession, train: DataFrame, test: DataFrame, ranks=GRID_RANKS,
         regs=GRID_REGS, max_iter: int = MAX_ITER, parallelism: int = 1) -> DataFrame:
    """(rank, regParam, rmse) for every grid point.  Fits run over one persisted split, by
    default one at a time, as each shuffles both sides' factors to all blocks in an iteration; what a
    fit left on disk goes before the next one."""
    train = train.select("userId", "productId", "score").persist()
    test = test.select("userId", "productId", "score").persist()

    def one(point):
        rank, reg = point
        row = rmse(predict(fit(train, rank, max_iter, reg), test)).first()
        _let_go(spark)
        return (rank, float(reg), float(row["rmse"]) if row["rmse"] is not None else None)

    points = [(r, g) for r in ranks for g in regs]
    try:
        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            rows = list(pool.map(one, points))
    finally:
        train.unpersist()
        test.unpersist()
    return spark.createDataFrame(rows, "rank int, regParam double, rmse double")


def _let_go(spark: SparkSession) -> None:
    """Have Spark remove shuffle files and cached blocks that nothing refers to any more, as it does whenever
    the driver happens to collect its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def best_params(grid_df: DataFrame) -> DataFrame:
    """Grid point with the lowest RMSE; ties go to the smaller rank, then regParam."""
    return grid_df.orderBy(F.col("rmse").asc_nulls_last(), "rank", "regParam").limit(1)
