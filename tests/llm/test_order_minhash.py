"""Near-duplicates: alignment against brute force, planted copies, hot groups, awkward rows."""

import random
from collections import defaultdict

import numpy as np
from hypothesis import given, settings, strategies as st
from llm.helpers import AWKWARD, docs
from pyspark.sql import functions as F
from rateflow.llm import order_minhash as o
from rateflow.llm.components import components


def distance(x, y):
    d = list(range(len(y) + 1))
    for i, a in enumerate(x):
        p, d = d, [i + 1] + [0] * len(y)
        for j, b in enumerate(y):
            d[j + 1] = min(p[j] + (a != b), p[j + 1] + 1, d[j] + 1)
    return d[-1]


def similar(s, t):
    x, y = s.split(), t.split()
    return 5 * distance(x, y) <= max(len(x), len(y))


words = st.lists(st.sampled_from("abcd"), max_size=25).map(" ".join)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(words, words), min_size=1, max_size=6))
def test_alignment_is_exact(pairs):
    assert o.alike(pairs) == [similar(s, t) for s, t in pairs]


def edited(rng, text, n):
    w = text.split()
    for _ in range(n):
        k = rng.randrange(len(w))
        kind = rng.randrange(3)
        if kind == 0:
            w[k] = f"new{rng.randrange(10**6)}"
        elif kind == 1:
            w.insert(k, f"ins{rng.randrange(10**6)}")
        elif len(w) > 2:
            del w[k]
    return " ".join(w)


def test_alignment_of_edited_texts():
    rng = random.Random(8)
    pairs = []
    for n in (40, 90, 200, 330):
        base = " ".join(f"w{rng.randrange(60)}" for _ in range(n))
        for edits in (0, 1, n // 10, n // 6, n // 5, n // 4, n // 2):
            pairs.append((base, edited(rng, base, edits)))
    assert o.alike(pairs) == [similar(s, t) for s, t in pairs]


def test_equal_words_give_equal_sketches_whatever_repeats():
    plain = np.arange(1, 60, dtype=np.uint64)
    twice = np.concatenate([plain, plain[-8:]])  # repeats some k-mers
    assert (o.sketch(plain) == o.sketch(twice)).mean() > 0.5


def test_bags_bound_the_distance_and_tell_long_texts_apart(spark):
    rng = random.Random(21)
    text = lambda n, of: " ".join(f"w{rng.randrange(of)}" for _ in range(n))
    texts = [text(n, of) for n in (0, 3, 150, 800, 5000, 70_000) for of in (9, 4000)]
    codes = [o.word_codes(o.code_points(t)) for t in texts]
    assert all(len(o.bag(c)) <= 2 * o.BAG_CELLS for c in codes)
    for n in (o.FEW_CELLS, o.BAG_CELLS):
        for c, h in zip(codes, o.histograms([o.bag(c) for c in codes], n)):
            if len(c) <= 65535:  # numbers beyond are cut, and such texts always compared
                assert (h == np.bincount((c % np.uint64(n)).astype(int), minlength=n)).all()
    # A passage that is 70 % of texts whose other words differ: one bucket, no pair to align.
    passage = text(600, 10**6)
    rows = [(k, passage + " " + text(260, 10**6)) for k in range(40)]
    rows += [(100 + k, edited(rng, passage, 20)) for k in range(3)]
    sketches = o.written(o._sketches(spark.createDataFrame(rows, "node long, text string")))
    nodes = sketches.select("node", F.explode("keys").alias("key"), F.col("node").alias("root"), F.lit(len(rows)).alias("n"))
    got = {(r.a, r.b) for r in o._open_pairs(nodes, sketches, None).collect()}
    assert got == {(101, 100), (102, 100), (102, 101)}


def test_later_links_join_roots(spark):
    first = [(5, 2), (9, 2), (8, 7), (20, 11)]
    later = [(9, 8), (30, 20), (41, 40), (11, 20)]
    edges = lambda rows: spark.createDataFrame(rows, "a long, b long")
    got = o._merged(components(edges(first)), edges(later)).collect()
    want = components(edges(first + later)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(got) == 7


def planted(rng):
    rows, group, nr = [], {}, 0
    passage = " ".join(f"common{k}" for k in range(60))
    for g in range(60):
        base = " ".join(f"g{g}w{rng.randrange(900)}" for _ in range(rng.randrange(60, 200)))
        if g % 3 == 0:
            base += " " + passage  # shared, yet no near-duplicates
        for k in range(rng.choice([1, 1, 2, 4])):
            rows.append((nr, base if k == 1 else edited(rng, base, 0 if k == 0 else 4)))
            group[nr] = g
            nr += 1
    for k in range(40):  # one large group of near copies, one of exact copies
        rows.append((nr, edited(rng, "big " + " ".join(f"h{i}" for i in range(120)), 3)))
        group[nr] = "near"
        nr += 1
        rows.append((nr, "exact " + " ".join(f"x{i}" for i in range(30))))
        group[nr] = "exact"
        nr += 1
    return rows, group


def test_planted_groups_are_found(spark):
    rows, group = planted(random.Random(9))
    d = docs(spark, rows, ["node", "class_id", "a", "b"])
    got = {r.doc_id: r for r in o.classes(d).collect()}
    found, want = defaultdict(set), defaultdict(set)
    for i, g in group.items():
        want[g].add(i)
        found[got[i].class_id].add(i)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, want.values()))
    assert all(c == min(members) for c, members in found.items())
    assert all(got[i].class_size == len(want[g]) and got[i].is_first == (i == min(want[g])) for i, g in group.items())
    kept = o.deduplicated(d)
    assert kept.columns == d.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(min(m) for m in want.values())


def test_awkward_rows(spark):
    d = docs(spark, AWKWARD)
    got = o.classes(d).collect()
    assert len(got) == len(AWKWARD)
    by = {r.doc_id: r.class_id for r in got}
    assert by[1] == by[2] == by[3] == 1 and by[6] == by[7] == 6
    assert by[4] == 4 and by[5] == 5 and by[8] == 8 and by[None] is None
    kept = sorted((r.doc_id or -1) for r in o.deduplicated(d).collect())
    assert kept == [-1, 1, 4, 5, 6, 8, 9]
    twice = docs(spark, [(3, "t u v"), (3, "t u v"), (None, "t u v")])
    assert [r.doc_id for r in o.deduplicated(twice).collect()] == [3]
    assert o.classes(docs(spark, [])).collect() == [] == o.deduplicated(docs(spark, [])).collect()


def test_components(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 440)]
    edges += [(500, 600 + k) for k in range(60)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in edges:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in parent if find(x) != x}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_unlike_members_of_a_bucket_meet_too(spark, monkeypatch):
    monkeypatch.setattr(o, "BLOCK", 16)
    rng = random.Random(12)
    base = [f"w{rng.randrange(5000)}" for _ in range(200)]

    def copy(n):
        w = list(base)
        for k in rng.sample(range(200), n):
            w[k] = f"s{rng.randrange(10**6)}"
        return " ".join(w)
    # Copies are alike to the original, but not to each other.
    rows = [(0, " ".join(base))] + [(1 + k, copy(24)) for k in range(999)]
    # A common passage that is half of many texts makes no class; pairs among them are found.
    passage = " ".join(f"p{i}" for i in range(60))
    for k in range(80):
        text = passage + " " + " ".join(f"t{k}x{i}" for i in range(60))
        rows += [(2000 + 2 * k, text), (2001 + 2 * k, edited(rng, text, 3))]
    got = {r.doc_id: r.class_id for r in o.classes(docs(spark, rows)).collect()}
    assert sum(got[k] == 0 for k in range(1000)) >= 990
    assert all(got[2000 + 2 * k] == got[2001 + 2 * k] == 2000 + 2 * k for k in range(80))
