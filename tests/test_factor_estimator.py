"""The factor model as an ML stage: saved and loaded, tuned, and its errors computed again by SQL."""

import tempfile

import duckdb
import numpy as np
import pytest
from pyspark.ml.tuning import TrainValidationSplitModel

from rateflow.operators import factor_estimator as fe
from rateflow.operators import normal_equations as ne

RATINGS = "userId int, productId int, score double"


def _ratings(spark, users=40, items=25, seed=1):
    rng = np.random.default_rng(seed)
    u, v = rng.normal(size=(users, 2)), rng.normal(size=(items, 2))
    rows = [(i, j, float(u[i] @ v[j] + 0.1 * rng.normal())) for i in range(users) for j in range(items) if rng.random() < 0.5]
    return spark.createDataFrame(rows, RATINGS).coalesce(2)


def test_fit_save_and_load(spark):
    r = _ratings(spark)
    base = tempfile.mkdtemp(prefix="rf-ml-")
    est = fe.RidgeFactors(rank=2, maxIter=4, regParam=0.05)
    est.write().save(f"{base}/est")
    again = fe.RidgeFactors.load(f"{base}/est")
    assert (again.getRank(), again.getMaxIter(), again.getRegParam()) == (2, 4, 0.05)
    model = again.fit(r)
    users, _ = ne.fit(r, 2, 4, 0.05)
    want = {x.userId: x.features for x in users.collect()}
    assert all(np.allclose(x.features, want[x.userId]) for x in model.userFactors.collect())
    model.write().save(f"{base}/model")
    loaded = fe.RidgeFactorsModel.load(f"{base}/model")
    key = lambda df: sorted((x.userId, x.productId, round(x.prediction, 9)) for x in df.collect())
    assert key(loaded.transform(r)) == key(model.transform(r)) and loaded.getRank() == 2
    assert loaded.transform(spark.createDataFrame([(999, 1, 1.0)], RATINGS)).count() == 0
    folded = {x.userId: x.features for x in loaded.fold_in(r).collect()}
    assert all(np.allclose(folded[k], want[k], atol=1e-9) for k in want)


def test_choice_of_a_tuner_computed_again_by_sql(spark):
    r = _ratings(spark).checkpoint()
    base = tempfile.mkdtemp(prefix="rf-tune-")
    search = fe.tuner((1, 2), (0.01, 1.0), max_iter=3)
    fitted = search.fit(r)
    points = fe.points(fitted)
    assert len(points) == 4
    # The tuner's own split, written with every point's factor tables.
    _, test = r.randomSplit([0.8, 0.2], ne.SEED)
    errors = {}
    for n, (rank, reg, _) in enumerate(points):
        fitted.subModels[n].userFactors.write.parquet(f"{base}/u{n}")
        fitted.subModels[n].itemFactors.write.parquet(f"{base}/i{n}")
    test.write.parquet(f"{base}/test")
    for n, (rank, reg, rmse) in enumerate(points):
        errors[rank, reg] = duckdb.execute(f"""
            SELECT sqrt(avg((t.score - list_dot_product(u.features, i.features)) ** 2))
            FROM '{base}/test/*.parquet' t JOIN '{base}/u{n}/*.parquet' u USING (userId) JOIN '{base}/i{n}/*.parquet' i USING (productId)
            """).fetchall()[0][0]
        assert errors[rank, reg] == pytest.approx(rmse, rel=1e-9)
    best = min(errors, key=errors.get)
    assert (fitted.bestModel.getRank(), fitted.bestModel.getRegParam()) == best == min(points, key=lambda p: p[2])[:2]
    fitted.bestModel.write().save(f"{base}/best")
    assert fe.RidgeFactorsModel.load(f"{base}/best").getRank() == best[0]
    assert isinstance(fitted, TrainValidationSplitModel)
