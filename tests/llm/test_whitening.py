"""Whitening: brute force in extended precision, exact sums, clusters, awkward rows."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from rateflow.llm import whitening as w

VECTORS = "vec_id long, embedding array<float>"


def rows_of(spark, rows, **more):
    df = spark.createDataFrame(rows, VECTORS).withColumn("n", F.lit("clash")).withColumn("v", F.lit(1))
    return w.whiten(df, **more).collect()


def brute(vectors, k):
    """Deviations, spectrum and projections by the definition, with whole numbers as far as they go."""
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    e = [[n * c - s for c, s in zip(v, sums)] for v in x]
    y = np.array([[c / n for c in v] for v in e])
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    return n, [sum(c * c for c in v) for v in e], values, (y @ vectors / np.sqrt(np.maximum(values, 1e-9)))[:, :k]


def test_equals_brute_force_over_several_tasks(spark):
    rng = random.Random(5)
    scale = [0.5 * 0.9 ** i for i in range(40)]
    vectors = [[rng.gauss(0.1, s) + 0.01 for s in scale] for _ in range(900)]
    vectors += vectors[:3]
    got = rows_of(spark, list(enumerate(vectors)))
    n, deviations, values, white = brute(vectors, 32)
    assert len(got) == 32 * n and {r.n for r in got} == {n} and {r.component for r in got} == set(range(1, 33))
    assert all(r.deviation == deviations[r.vec_id] for r in got)
    table = np.zeros((n, 32))
    for r in got:
        table[r.vec_id, r.component - 1] = r.whitened
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-9)
    assert np.abs(np.abs(table) - np.abs(white)).max() < 1e-7
    signs = np.sign((table * white).sum(axis=0))
    assert np.abs(table * signs - white).max() < 1e-7
    error = np.abs(table.T @ table / n - np.outer(table.mean(0), table.mean(0)) - np.eye(32)).max()
    assert {r.identity_error for r in got} == {got[0].identity_error}
    assert got[0].identity_error == pytest.approx(error, abs=1e-13) and got[0].identity_error < 1e-10


@pytest.mark.parametrize("spread", [None, 1e-7, 1e-12, 0.0])
def test_eigenvectors_to_double_precision_in_clusters(spread):
    rng = np.random.default_rng(2)
    q, _ = np.linalg.qr(rng.normal(size=(48, 48)))
    values = np.sort(rng.uniform(0.1, 20, 48))[::-1]
    if spread is not None:
        values[8:16] = values[8] * (1 - np.arange(8) * spread)
        values[-6:] = 0
    a = ((q * values) @ q.T).astype(np.longdouble)
    a = (a + a.T) / 2
    found, x = w.eigen(a)
    wide = x.astype(np.longdouble)
    assert np.abs(a @ wide - wide * found).max() < 1e-14 and (np.diff(found) <= 0).all()
    assert np.abs(wide.T @ wide - np.eye(48)).max() < 1e-15
    single = np.linalg.eigh(a.astype(np.float32))[1].astype(float)
    assert np.abs(a @ single - single * np.diag(single.T @ a @ single)).max() > 1e-8  # where it starts from


def test_sums_are_exact_whatever_the_size(spark):
    big = [(1, [1e15, 0.0]), (2, [-1e15, 1.5]), (3, [3e5, -2.25]), (4, [0.0, 0.0])]
    df = spark.createDataFrame(big, "vec_id long, v array<double>").repartition(3)
    x = [[math.floor(64 * c) for c in v] for _, v in big]
    n, sums = w.totals(df)[2]
    assert (n, sums) == (4, [sum(c) for c in zip(*x)])
    cov = w.covariance(df, {2: (n, sums)})[2]
    e = [[n * c - s for c, s in zip(v, sums)] for v in x]
    for i in range(2):
        for j in range(2):
            assert cov[i, j] * n ** 3 == sum(v[i] * v[j] for v in e)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [1.0, None]), (4, [nan, 1.0]), (5, [1.0, -inf]), (None, [0.5, 1.0]),
            (7, [0.25, 2.0]), (7, [0.25, 2.0]), (8, [3.0, 4.0, 5.0]), (9, [1.5, -0.5])]
    got = rows_of(spark, rows)
    assert sorted((r.vec_id or 0, r.component) for r in got) == [
        (0, 1), (0, 2), (7, 1), (7, 1), (7, 2), (7, 2), (8, 1), (8, 2), (8, 3), (9, 1), (9, 2)]
    assert {r.n for r in got if r.vec_id != 8} == {4}
    # A vector alone of its length has no variance.
    assert {(r.n, r.deviation, r.whitened, r.explained) for r in got if r.vec_id == 8} == {(1, 0, None, 0.0)}
    assert rows_of(spark, []) == [] and rows_of(spark, [(1, None)]) == []
    flat = rows_of(spark, [(i, [float(i), 1.0]) for i in range(5)], components=2)
    assert all((r.whitened is None) == (r.component == 2) for r in flat) and flat[0].identity_error < 1e-12
    huge = rows_of(spark, [(1, [1e18]), (2, [0.0]), (3, [1e30])])
    assert {r.deviation for r in huge} == {None} and all(math.isfinite(r.whitened) for r in huge)
