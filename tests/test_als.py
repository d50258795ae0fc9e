"""Invariants of the factor-model operators."""

import numpy as np
from pyspark.sql import functions as F

from rateflow.operators import als


def _planted(spark):
    rng = np.random.default_rng(1)
    u, v = rng.normal(size=(60, 2)), rng.normal(size=(40, 2))
    rows = []
    for i in range(60):
        for j in range(40):
            if rng.random() < 0.6:
                s = float(np.clip(3 + u[i] @ v[j], 1, 5))
                rows.append((i, j, s, i * 40 + j))
    return spark.createDataFrame(rows, "userId int, productId int, score double, timestamp int")


def test_user_recs_invariants_and_seed(spark):
    r = _planted(spark)
    m = als.fit(r, rank=2, max_iter=8, reg=0.05)
    recs = als.user_recs(m).collect()
    assert recs
    for row in recs:
        scores = [e.score for e in row.recs]
        assert 0 < len(scores) <= 20
        assert all(s > 0 for s in scores)
        assert scores == sorted(scores, reverse=True)
    f1 = sorted((x.productId, tuple(x.features)) for x in als.item_factors(m).collect())
    f2 = sorted((x.productId, tuple(x.features))
                for x in als.item_factors(als.fit(r, rank=2, max_iter=8, reg=0.05)).collect())
    assert f1 == f2


def test_rmse_beats_global_mean(spark):
    s = als.arithmetic_split(_planted(spark))
    train, test = s.where(F.col("split") == "train"), s.where(F.col("split") == "test")
    m = als.fit(train, rank=2, max_iter=10, reg=0.05)
    model_rmse = als.rmse(als.predict(m, test)).first().rmse
    mean = train.agg(F.avg("score")).first()[0]
    base = als.rmse(test.withColumn("prediction", F.lit(mean))).first().rmse
    assert model_rmse < base


def test_best_params_picks_min(spark):
    g = spark.createDataFrame([(5, 1.0, 0.9), (10, 0.1, 0.7), (20, 0.1, 0.7)],
                              "rank int, regParam double, rmse double")
    assert tuple(als.best_params(g).first()) == (10, 0.1, 0.7)


def test_block_lists_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    u, v = rng.normal(size=(70, 5)), rng.normal(size=(90, 5))
    v[7] = v[3]      # a tie
    schema = "{} int, features array<double>"
    users = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(u)], schema.format("userId"))
    items = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], schema.format("productId"))
    from rateflow.operators.dense import best_per_block
    got = {}
    for r in als.top_products(users, items, 6).collect():
        got.setdefault(r.userId, []).append((r["rank"], r.productId))
    small = best_per_block(users, items, 6, "userId", "productId", block_size=16)
    again = {}
    for r in small.collect():
        again.setdefault(r.userId, []).append((-round(r.score, 9), r.productId))
    for i in range(70):
        s = np.round(u[i] @ v.T, 9)
        want = [int(j) for j in np.lexsort((np.arange(90), -s)) if s[j] > 0][:6]
        assert [p for _, p in sorted(got.get(i, []))] == want
        assert [p for _, p in sorted(again.get(i, []))[:6]] == want


def test_user_recs_match_the_library(spark):
    m = als.fit(_planted(spark), rank=2, max_iter=5, reg=0.05)
    want = {r.userId: [x.productId for x in r.recommendations if x.rating > 0] for r in m.recommendForAllUsers(20).collect()}
    got = {r.userId: [x.productId for x in r.recs] for r in als.user_recs(m).collect()}
    assert {k: sorted(x) for k, x in got.items()} == {k: sorted(x) for k, x in want.items() if x}


def test_product_recs_with_and_without_a_limit(spark):
    m = als.fit(_planted(spark), rank=2, max_iter=5, reg=0.05)
    whole = als.product_recs(m).collect()
    top = als.product_recs(m, k=3).collect()
    assert sorted((r.productId, r["rank"], r.simProductId) for r in top) == \
        sorted((r.productId, r["rank"], r.simProductId) for r in whole if r["rank"] <= 3)


def test_random_split_is_a_partition(spark):
    rows = _planted(spark)
    train, test = als.random_split(rows)
    key = lambda d: {(r.userId, r.productId) for r in d.collect()}
    assert not key(train) & key(test) and len(key(train) | key(test)) == rows.count()
    assert 0.7 < train.count() / rows.count() < 0.9


def test_grid_holds_one_fit_at_a_time(spark, monkeypatch):
    import threading
    rows = _planted(spark)
    now, most, left, lock = [0], [0], [], threading.Lock()
    fit, told = als.fit, als.rmse

    def counted(*a):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        return fit(*a)

    def done(predicted):
        with lock:
            now[0] -= 1
        return told(predicted)

    monkeypatch.setattr(als, "fit", counted)
    monkeypatch.setattr(als, "rmse", done)
    monkeypatch.setattr(als, "_let_go", lambda s, f=als._let_go: (left.append(1), f(s)))
    assert als.grid(spark, rows, rows, (1, 2), (1.0, 0.1), max_iter=2).count() == 4
    assert most[0] == 1 and len(left) == 4
    assert als.als().getCheckpointInterval() == 1
