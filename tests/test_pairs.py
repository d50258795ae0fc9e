"""Pair sums (co-rating, partial dots) against brute force, hot groups split."""

import itertools
from collections import Counter, defaultdict

from hypothesis import given, settings, strategies as st

from rateflow.operators import itemcf
from rateflow.operators.pairs import pair_sums


def _brute(rows):
    groups = defaultdict(dict)
    for g, i, w in rows:
        groups[g][i] = groups[g].get(i, 0) + w
    out = Counter()
    for items in groups.values():
        for a, b in itertools.combinations(sorted(items), 2):
            out[(a, b)] += items[a] * items[b]
    return dict(out)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 30), st.integers(1, 3)),
                min_size=1, max_size=120),
       st.sampled_from([1, 2, 5, 1024]))
def test_pair_sums_equal_brute_force(spark, rows, block):
    # one row per (group, item)
    dedup = {}
    for g, i, w in rows:
        dedup[(g, i)] = w
    data = [(g, i, w) for (g, i), w in dedup.items()]
    df = spark.createDataFrame(data, "g int, i int, w long")
    got = {(r.item1, r.item2): r.total for r in pair_sums(df, "g", "i", "w", block_items=block).collect()}
    assert got == _brute(data)


def test_cooccurrence_counts_duplicates_and_self(spark):
    r = spark.createDataFrame([(1, 10), (1, 10), (1, 20), (2, 10), (2, 30), (3, 40)],
                              "userId int, productId int")
    co = {(x.product1, x.product2): (x.cocount, x.count1, x.count2)
          for x in itemcf.cooccurrence(r).collect()}
    assert co[(10, 20)] == (2, 3, 1)        # user 1 rated 10 twice
    assert co[(10, 10)] == (5, 3, 3)        # self pair: 2*2 + 1*1
    assert co[(20, 10)] == (2, 1, 3)
    assert (40, 40) in co and not any(k[0] == 40 and k[1] != 40 for k in co)


def test_lone_item_gets_empty_list(spark):
    r = spark.createDataFrame([(1, 10), (1, 20), (2, 10), (3, 99)], "userId int, productId int")
    recs = {x.productId: [(e.productId, round(e.score, 6)) for e in x.recs]
            for x in itemcf.product_recs(r).collect()}
    assert recs[99] == []
    assert recs[20] == [(10, round(1 / 2 ** 0.5, 6))]


def test_similarity_symmetric(spark):
    r = spark.createDataFrame([(u, p) for u in range(6) for p in range(u, u + 4)],
                              "userId int, productId int")
    s = {(x.product1, x.product2): x.sim for x in itemcf.similarity(r).collect()}
    assert all(abs(s[(b, a)] - v) < 1e-12 for (a, b), v in s.items())


def test_dedup_keeps_similarity_at_most_one(spark):
    r = spark.createDataFrame([(1, 10), (1, 10), (1, 10), (1, 20), (2, 20)],
                              "userId int, productId int")
    raw = {(x.product1, x.product2): x.sim for x in itemcf.similarity(r).collect()}
    ded = {(x.product1, x.product2): x.sim for x in itemcf.similarity(r, dedup=True).collect()}
    assert raw[(10, 20)] > 1 - 1e-12 and raw[(10, 20)] == 3 / (3 * 2) ** 0.5
    assert ded[(10, 20)] == 1 / 2 ** 0.5


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 8)), min_size=1, max_size=60))
def test_mirrored_half_equals_full_self_join(spark, rows):
    r = spark.createDataFrame(rows, "userId int, productId int")
    n = Counter(p for _, p in rows)
    full = Counter()
    for u1, p1 in rows:              # the plain self-join on the user, both orders
        for u2, p2 in rows:
            if u1 == u2:
                full[(p1, p2)] += 1
    got = {(x.product1, x.product2): (x.cocount, x.count1, x.count2)
           for x in itemcf.cooccurrence(r).collect()}
    assert got == {k: (v, n[k[0]], n[k[1]]) for k, v in full.items()}


def test_top_neighbours_without_the_pairs_of_hot_users(spark):
    import random

    from rateflow.operators import itemcf
    rnd = random.Random(5)
    rows = [(0, p, 3.0) for p in range(60)] + [(1, p, 3.0) for p in range(0, 60, 2)] + [(1, 4, 1.0), (None, 3, 1.0), (2, None, 1.0), (0, None, 2.0)]
    rows += [(rnd.randrange(3, 30), rnd.randrange(70), 1.0) for _ in range(250)]
    r = spark.createDataFrame(rows, "userId int, productId int, score double")
    for dedup in (False, True):
        want = itemcf.neighbours_of(itemcf.similarity(r, dedup).where("product1 <> product2"), 7).collect()
        got = itemcf.top_neighbours(r, 7, dedup, hot_items=25)
        key = lambda x: (x.productId, x["rank"], x.simProductId, round(x.score, 9))
        assert sorted(map(key, got.collect())) == sorted(map(key, want))
