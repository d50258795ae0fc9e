"""Least-squares steps of the factor model as grouped vector aggregates.

With one side's factors fixed, each id of the other side has its own ridge problem

    (sum over its ratings of f f' + reg * n * I) x = sum over its ratings of score * f

The left and right sides are plain sums per id over ratings joined with factors, dealt by id
first and combined before they are shuffled: an id with a third of all ratings sends one row per
task.  The small systems are then solved in Arrow batches, many at once.  The weight of
the ridge grows with the id's ratings, as in the library's own solver, so one step here
reproduces what that solver did last; it checks a fitted model, folds in new users without
a new fit, and alternated from hashed starting values it is a solver itself.

Ids without a rated partner among the given factors get no row.  Null scores and ids are
left out.  Repeated ratings count each time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rateflow.session import shared_dir

SEED = 42


def _upper(rank: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(rank) for j in range(i, rank)]


def rank_of(factors: DataFrame) -> int:
    """Length of the factor vectors (0 for an empty table)."""
    first = factors.select(F.size("features").alias("n")).first()
    return first["n"] if first else 0


def equations(ratings: DataFrame, factors: DataFrame, own: str, other: str, rank: int,
              score: str = "score") -> DataFrame:
    """(own, n, a array, b array): the sums of one system per id of ``own``; ``a`` is the upper triangle."""
    f = factors.select(F.col(other).alias("_o"), *[F.col("features")[i].cast("double").alias(f"_f{i}") for i in range(rank)])
    r = ratings.select(F.col(own).alias("_i"), F.col(other).alias("_o"), F.col(score).cast("double").alias("_s")).dropna()
    pairs = _upper(rank)
    # Rows of a rating and a vector are shorter than partial sums: they are shuffled by id, so that
    # each task combines whole ids.  The extra column is not the grouped one, so the sums
    # meet once more, and Spark may deal a hot id over several tasks.
    rows = r.join(f, "_o").drop("_o").withColumn("_part", F.pmod(F.hash("_i"), F.lit(1 << 16))).hint("rebalance", "_part")
    sums = rows.groupBy("_i").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.col(f"_f{i}") * F.col(f"_f{j}")).alias(f"_a{i}_{j}") for i, j in pairs],
        *[F.sum(F.col("_s") * F.col(f"_f{i}")).alias(f"_b{i}") for i in range(rank)])
    return sums.select(F.col("_i").alias(own), "n", F.array(*[f"_a{i}_{j}" for i, j in pairs]).alias("a"),
                       F.array(*[f"_b{i}" for i in range(rank)]).alias("b"))


def _systems(batch: pa.RecordBatch, rank: int, reg: float) -> tuple[np.ndarray, np.ndarray]:
    """Matrices and right sides of a batch of equations."""
    m = batch.num_rows
    upper = batch.column(2).flatten().to_numpy().reshape(m, -1)
    a = np.zeros((m, rank, rank))
    for at, (i, j) in enumerate(_upper(rank)):
        a[:, i, j] = a[:, j, i] = upper[:, at]
    a[:, range(rank), range(rank)] += reg * batch.column(1).to_numpy()[:, None]
    return a, batch.column(3).flatten().to_numpy().reshape(m, rank)


def solve(sums: DataFrame, own: str, rank: int, reg: float) -> DataFrame:
    """(own, features): the solution of each row of ``equations``."""
    if not reg > 0:
        raise ValueError(f"the ridge must be above 0, not {reg}: an id with few ratings has no single solution")
    kind = sums.schema[own].dataType.simpleString()

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                a, b = _systems(batch, rank, reg)
                x = np.linalg.solve(a, b[:, :, None])[:, :, 0]
                ends = pa.array(np.arange(0, x.size + 1, rank), pa.int32())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(ends, pa.array(x.ravel()))],
                                                 names=[own, "features"])

    return sums.mapInArrow(run, f"{own} {kind}, features array<double>")


def half_step(ratings: DataFrame, factors: DataFrame, own: str, other: str, reg: float,
              rank: int | None = None) -> DataFrame:
    """(own, features): the best factors of one side for the other side's."""
    rank = rank or rank_of(factors)
    return solve(equations(ratings, factors, own, other, rank), own, rank, reg)


def fold_in(new_ratings: DataFrame, items: DataFrame, reg: float) -> DataFrame:
    """(userId, features) of users that the model never saw, from their ratings of known products."""
    return half_step(new_ratings, items, "userId", "productId", reg)


def residuals(ratings: DataFrame, solved: DataFrame, factors: DataFrame, own: str, other: str, reg: float) -> DataFrame:
    """(own, residual): how far each solved vector misses its equations, as a share of the largest right side."""
    rank = rank_of(factors)
    kind = solved.schema[own].dataType.simpleString()
    rows = (equations(ratings, factors, own, other, rank)
            .join(solved.select(own, F.col("features").cast("array<double>").alias("x")), own))

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                a, b = _systems(batch, rank, reg)
                x = batch.column(4).flatten().to_numpy().reshape(-1, rank)
                off = np.abs(np.einsum("mij,mj->mi", a, x) - b).max(axis=1)
                scale = np.abs(b).max(axis=1)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(off / np.where(scale > 0, scale, 1.0))],
                                                 names=[own, "residual"])

    return rows.mapInArrow(run, f"{own} {kind}, residual double")


def start(ids: DataFrame, key: str, rank: int, seed: int = SEED) -> DataFrame:
    """(key, features): starting factors between 0 and 1 over the root of the rank, by a hash of the id."""
    def unit(i: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(seed), F.lit(i), F.col(key)), F.lit(1 << 30)) / float((1 << 30) * rank ** 0.5)

    return ids.select(key).dropna().distinct().select(key, F.array(*[unit(i) for i in range(rank)]).alias("features"))


def fit(ratings: DataFrame, rank: int, max_iter: int, reg: float, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(user factors, item factors) by alternating half steps, the users' last.

    Each half step is written to the shared folder: plans stay short and a lost executor
    repeats one step at most.  The same ratings give the same starting values in any order.
    """
    shared_dir(ratings.sparkSession)
    r = ratings.select("userId", "productId", "score").dropna().checkpoint()
    users = start(r, "userId", rank, seed)
    items = start(r, "productId", rank, seed)
    for _ in range(max_iter):
        items = half_step(r, users, "productId", "userId", reg, rank).checkpoint()
        users = half_step(r, items, "userId", "productId", reg, rank).checkpoint()
    return users, items


def predict(pairs: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """``pairs`` (userId, productId, ...) with ``prediction``; pairs with an unknown id give no row."""
    u = users.select("userId", F.col("features").alias("_u"))
    v = items.select("productId", F.col("features").alias("_v"))
    products = F.zip_with("_u", "_v", lambda a, b: a.cast("double") * b.cast("double"))
    return (pairs.join(u, "userId").join(v, "productId")
            .withColumn("prediction", F.aggregate(products, F.lit(0.0), lambda s, x: s + x)).drop("_u", "_v"))


def holdout_grid(train: DataFrame, test: DataFrame, items: DataFrame, ranks, regs) -> DataFrame:
    """(rank, regParam, rmse): error on ``test`` of users folded in by ``train``, per grid point.

    All points share one pass: the sums of the largest rank hold those of the smaller ones,
    so each user's systems are solved side by side and each held-out rating is joined once.
    """
    top = max(ranks)
    points = [(r, float(g)) for r in ranks for g in regs]
    sums = equations(train, items, "userId", "productId", top)
    kind = sums.schema["userId"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            m = batch.num_rows
            if not m:
                continue
            x = np.zeros((m, len(points), top))
            for at, (rank, reg) in enumerate(points):
                a, b = _systems(batch, top, reg)
                x[:, at, :rank] = np.linalg.solve(a[:, :rank, :rank], b[:, :rank, None])[:, :, 0]
            ends = pa.array(np.arange(0, x.size + 1, x[0].size), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(ends, pa.array(x.ravel()))],
                                             names=["userId", "_x"])

    users = sums.mapInArrow(run, f"userId {kind}, _x array<double>")
    v = items.select("productId", *[F.col("features")[i].alias(f"_v{i}") for i in range(top)])
    # Users' solutions are long, so held-out ratings meet the items first.
    rows = test.select("userId", "productId", "score").join(v, "productId").drop("productId").join(users, "userId")

    def error(at: int) -> Column:
        dot = sum((F.col("_x")[at * top + i] * F.col(f"_v{i}") for i in range(1, points[at][0])),
                  F.col("_x")[at * top] * F.col("_v0"))
        return F.sqrt(F.avg(F.pow(F.col("score") - dot, 2)))

    one = rows.agg(F.array(*[F.struct(F.lit(r).cast("int").alias("rank"), F.lit(g).alias("regParam"), error(at).alias("rmse"))
                             for at, (r, g) in enumerate(points)]).alias("p"))
    return one.select(F.explode("p").alias("p")).select("p.*")
