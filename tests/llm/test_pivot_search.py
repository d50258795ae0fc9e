"""Exact search: brute force, ties, odd vectors, several blocks."""

import math
import random

from pyspark.sql import functions as F
from rateflow.llm import pivot_search as s

VECTORS = "vec_id long, embedding array<float>"


def brute(rows, k=5, every=50):
    usable = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            usable.setdefault(i, []).append([math.floor(256 * x) for x in v])
    out = []
    for i in sorted(usable):
        if i % every == 0:
            q = min(usable[i])
            scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, vs in usable.items() if j != i for v in vs if len(v) == len(q))
            out += [(i, r + 1, j, -x) for r, (x, j) in enumerate(scored[:k])]
    return out


def found(spark, rows, **more):
    df = spark.createDataFrame(rows, VECTORS).withColumn("block", F.lit("clash")).withColumn("dim", F.lit(0))
    return sorted(tuple(r) for r in s.top_k(df, F.expr("vec_id % 50 = 0"), **more).collect())


def half(x):
    return round(x * 512) / 512  # exact as a float


def test_equals_brute_force_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(s, "CANDIDATE_BLOCK", 64)
    monkeypatch.setattr(s, "QUERY_BLOCK", 4)
    rng = random.Random(3)
    rows = [(i, [half(rng.gauss(0, 0.3)) for _ in range(8)]) for i in range(600)]
    rows += [(i, rows[0][1]) for i in range(600, 640)]  # ties
    assert found(spark, rows) == brute(rows)


def test_odd_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.25]), (50, None), (100, []), (150, [nan, 1.0]), (200, [inf, 1.0]), (1, [None, 1.0]), (2, [0.0, 0.0]),
            (3, [-0.001953125, 1.0]), (4, [0.5, 0.5, 0.5]), (5, [1e30, 1.0]), (None, [1.0, 1.0]), (0, [0.5, -0.25]), (7, [1.0, 1.0]), (7, [1.0, 1.0])]
    assert found(spark, rows) == brute([r for r in rows if r[0] != 5])
    assert found(spark, []) == []
    assert found(spark, [(0, [1.0])]) == []


def test_large_components_stay_exact(spark):
    rows = [(i, [100_000.0 + i, -90_000.0 - 3 * i, 5.0]) for i in range(120)]
    assert found(spark, rows, k=7) == brute(rows, 7)


def test_huge_components_beside_small_ones(spark):
    rng = random.Random(9)
    rows = [(i, [half(rng.gauss(0, 0.3)) for _ in range(3)]) for i in range(110)]
    rows += [(200 + i, [3.0e5 + i, 1.0, -2.0 ** (i + 18)]) for i in range(8)] + [(300, [2.0 ** 21, 5.0, 0.5]), (301, [-2.0 ** 30, 1.0, 2.0 ** 15])]
    assert found(spark, rows) == brute(rows)


def test_bounds_stop_early():
    import numpy as np
    rng = np.random.default_rng(1)
    centres = rng.integers(-200, 200, (8, 16))
    c = (centres[rng.integers(0, 8, 4000)] + rng.integers(-3, 4, (4000, 16))).astype(np.int64)
    pivots = s.choose_pivots(c[:500].tolist())
    table = np.sqrt(np.stack([((c - p) ** 2).sum(1) for p in pivots], 1))
    q = (np.array([5]), c[5:6], table[5:6])
    got = sorted(s.eliminate(q, (np.arange(4000), c, table), 5, [None])[0], key=lambda x: (-x[1], x[0]))
    scores = c @ c[5]
    scores[5] = -10**9
    want = sorted((-int(x), j) for j, x in enumerate(scores))[:5]
    assert got == [(j, -x) for x, j in want]


def test_driver_sees_a_share_of_the_pivot_sample_per_task(spark, monkeypatch):
    monkeypatch.setattr(s, "PIVOT_SAMPLE", 50)
    rows = spark.range(0, 8000, 1, 40).select(F.col("id").alias("vec_id"), F.array("id", F.lit(1)).alias("v"))
    sc = spark.sparkContext
    read = sc.accumulator(0)
    monkeypatch.setattr(type(rows), "limit", lambda self, n, f=type(rows).limit: f(self.where(told("v")), n))

    def count(v):
        read.add(1)
        return True

    told = F.udf(count, "boolean")
    assert 40 <= len(s._sample(rows, 8000)) <= 50
    assert read.value <= 200      # 40 tasks; 50 each would be 2,000


def test_candidates_are_shuffled_once_per_group_of_queries(spark, monkeypatch):
    monkeypatch.setattr(s, "CANDIDATE_BLOCK", 64)
    monkeypatch.setattr(s, "QUERY_BLOCK", 2)
    rng = random.Random(5)
    rows = [(i, [half(rng.gauss(0, 0.3)) for _ in range(8)]) for i in range(1000)]
    sent = []
    search = s._search
    monkeypatch.setattr(s, "_search", lambda q, c, *a, **b: (sent.append((q.count(), c.count())), search(q, c, *a, **b))[1])
    assert found(spark, rows) == brute(rows)
    # 20 queries in about 10 blocks, 16 blocks of candidates, one group: none is copied for each query block.
    assert sent[1][1] == 16
    sent.clear()
    monkeypatch.setattr(s, "HELD_BYTES", 3 * 2 * (8 * 8 + 4 * s.PIVOTS + 32 * 5))
    assert found(spark, rows) == brute(rows)
    assert sent[1][1] == 16 * 4
