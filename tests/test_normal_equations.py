"""Least-squares steps: brute force, hot ids, the library's own fit, folding in."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rateflow.operators import als
from rateflow.operators import normal_equations as ne

RATINGS = "userId int, productId int, score double"
VECTORS = "productId int, features array<double>"


def _planted(spark, users=80, items=50, rank=3, share=0.5, seed=1):
    rng = np.random.default_rng(seed)
    u, v = rng.normal(size=(users, rank)), rng.normal(size=(items, rank))
    rows = [(i, j, float(u[i] @ v[j])) for i in range(users) for j in range(items) if rng.random() < share]
    return spark.createDataFrame(rows, RATINGS), rows, v


def _brute(rows, factors, at, reg):
    """Solutions by the definition; ``at`` is the place of the solved id in a rating."""
    out = {}
    for key in {r[at] for r in rows}:
        f = np.array([factors[r[1 - at]] for r in rows if r[at] == key and r[1 - at] in factors])
        s = np.array([r[2] for r in rows if r[at] == key and r[1 - at] in factors])
        if len(f):
            out[key] = np.linalg.solve(f.T @ f + reg * len(f) * np.eye(f.shape[1]), f.T @ s)
    return out


@pytest.mark.parametrize("rank", [1, 5, 50])
def test_half_step_equals_brute_force(spark, rank):
    rng = np.random.default_rng(rank)
    factors = {j: rng.normal(size=rank) for j in range(30)}
    rows = [(int(rng.integers(20)), int(rng.integers(33)), float(rng.integers(1, 6))) for _ in range(500)]
    rows += [(99, j % 30, 4.0) for j in range(3000)]      # one id with most of the rows, and repeated ratings
    r = spark.createDataFrame(rows, RATINGS).repartition(6)
    f = spark.createDataFrame([(j, x.tolist()) for j, x in factors.items()], VECTORS)
    want = _brute(rows, factors, 0, 0.05)
    got = {x.userId: np.array(x.features) for x in ne.half_step(r, f, "userId", "productId", 0.05).collect()}
    assert got.keys() == want.keys()
    assert max(np.abs(got[k] - want[k]).max() for k in want) < 1e-9


def test_hot_ids_are_combined_before_the_shuffle(spark):
    rows = spark.range(5000).select(F.lit(1).alias("userId"), (F.col("id") % 40).cast("int").alias("productId"), F.lit(2.0).alias("score"))
    f = spark.range(40).select(F.col("id").cast("int").alias("productId"), F.array(F.lit(1.0), F.col("id") / 40).alias("features"))
    import contextlib
    import io
    said = io.StringIO()
    with contextlib.redirect_stdout(said):
        ne.equations(rows, f, "userId", "productId", 2).explain()
    plan = said.getvalue()
    assert "partial_sum" in plan and "collect_list" not in plan and "Python" not in plan


def test_awkward_ratings(spark):
    rows = [(1, 1, 5.0), (1, 2, None), (None, 1, 3.0), (2, None, 3.0), (3, 7, 1.0), (4, 1, 0.0)]
    f = spark.createDataFrame([(1, [1.0, 2.0]), (2, [0.5, 0.1])], VECTORS)
    r = spark.createDataFrame(rows, RATINGS)
    got = {x.userId: x.features for x in ne.half_step(r, f, "userId", "productId", 0.1).collect()}
    assert set(got) == {1, 4} and got[4] == [0.0, 0.0]
    assert ne.half_step(r.limit(0), f, "userId", "productId", 0.1).collect() == []
    assert ne.half_step(r, f.limit(0), "userId", "productId", 0.1).collect() == []
    assert ne.predict(r, ne.half_step(r, f, "userId", "productId", 0.1), f).count() == 3
    with pytest.raises(ValueError):
        ne.half_step(r, f, "userId", "productId", 0.0)


def test_the_librarys_fit_satisfies_its_equations(spark):
    r, rows, _ = _planted(spark)
    noisy = r.withColumn("score", F.col("score") + F.rand(3))
    noisy = noisy.checkpoint()
    m = als.fit(noisy, rank=4, max_iter=6, reg=0.05)
    off = als.residuals(m, noisy, 0.05)
    assert off.count() == noisy.select("userId").distinct().count()
    assert off.agg(F.max("residual")).first()[0] < 1e-3
    # With another ridge the same vectors miss.
    assert als.residuals(m, noisy, 0.5).agg(F.max("residual")).first()[0] > 1e-2


def test_folding_in_gives_the_fitted_vectors_and_serves_new_users(spark):
    r, rows, _ = _planted(spark)
    m = als.fit(r, rank=3, max_iter=12, reg=0.001)
    fitted = {x.userId: np.array(x.features) for x in als.user_factors(m).collect()}
    again = {x.userId: np.array(x.features) for x in als.fold_in(m, r, 0.001).collect()}
    assert fitted.keys() == again.keys() and max(np.abs(fitted[k] - again[k]).max() for k in fitted) < 1e-3
    # A new user with a known taste: half of somebody's ratings predict the other half.
    mine = [(1000, p, s) for u, p, s in rows if u == 7]
    seen, hidden = spark.createDataFrame(mine[::2], RATINGS), spark.createDataFrame(mine[1::2], RATINGS)
    told = ne.predict(hidden, als.fold_in(m, seen, 0.001), als.item_factors(m)).collect()
    assert len(told) == len(mine[1::2]) and max(abs(x.score - x.prediction) for x in told) < 0.3


def test_own_fit_converges_and_repeats(spark):
    r, rows, _ = _planted(spark)
    users, items = ne.fit(r, rank=3, max_iter=8, reg=0.001)
    told = ne.predict(r, users, items)
    assert als.rmse(told).first().rmse < 0.1
    assert ne.residuals(r, users, items, "userId", "productId", 0.001).agg(F.max("residual")).first()[0] < 1e-6
    again = {x.userId: x.features for x in ne.fit(r.orderBy(F.rand(1)), rank=3, max_iter=8, reg=0.001)[0].collect()}
    for x in users.collect():
        assert np.allclose(x.features, again[x.userId], atol=1e-6)


def test_grid_equals_separate_points(spark):
    r, rows, v = _planted(spark, users=30, items=20)
    train, test = rows[::2], rows[1::2]
    f = spark.createDataFrame([(j, x.tolist()) for j, x in enumerate(v)], VECTORS)
    got = {(g["rank"], g.regParam): g.rmse for g in ne.holdout_grid(
        spark.createDataFrame(train, RATINGS), spark.createDataFrame(test, RATINGS), f, (1, 3), (0.1, 1.0)).collect()}
    assert len(got) == 4
    for (rank, reg), rmse in got.items():
        cut = {j: x[:rank] for j, x in enumerate(v)}
        x = _brute(train, cut, 0, reg)
        want = np.sqrt(np.mean([(s - x[u] @ cut[p]) ** 2 for u, p, s in test if u in x]))
        assert rmse == pytest.approx(want, rel=1e-9)


def test_rows_are_dealt_by_id_before_they_are_summed(spark):
    rows = spark.range(3000).select((F.col("id") % 500).cast("int").alias("userId"), (F.col("id") % 40).cast("int").alias("productId"),
                                    F.lit(2.0).alias("score")).repartition(20)
    f = spark.range(40).select(F.col("id").cast("int").alias("productId"), F.array(F.lit(1.0), F.col("id") / 40).alias("features"))
    plan = ne.equations(rows, f, "userId", "productId", 2)._jdf.queryExecution().executedPlan().toString()
    # From the top: final sums, a shuffle, partial sums, rows dealt by id, the join.
    final, shuffled, partial, dealt, joined = (plan.index(x) for x in ("functions=[count", "Exchange hashpartitioning(_i", "partial_sum", "REBALANCE", "Join"))
    assert final < shuffled < partial < dealt < joined


def test_held_out_ratings_meet_the_items_before_the_long_solutions(spark):
    r, rows, v = _planted(spark, users=30, items=20)
    f = spark.createDataFrame([(j, x.tolist()) for j, x in enumerate(v)], VECTORS)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = ne.holdout_grid(r, r, f, (1, 3), (0.1,))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    joins = [line for line in plan.splitlines() if "SortMergeJoin" in line]
    assert "userId" in joins[0] and "productId" in joins[1]
