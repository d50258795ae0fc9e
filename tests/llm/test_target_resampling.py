"""Importance resampling: brute force for features, weights and ranks; awkward rows."""

import hashlib
import math
import random
import re
from zlib import crc32

import pytest
from llm.helpers import AWKWARD, docs
from rateflow.llm import target_resampling as t

TABLE = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(TABLE))


def features(text):
    w = words(text)
    return w + [f"{a} {b}" for a, b in zip(w, w[1:])]


def brute(rows, target):
    """Sorted (doc_id, n_features, weight, score, rank)."""
    bucket = {}
    def counts(texts):
        n = [0] * 10_000
        for text in texts:
            for f in features(text):
                n[bucket.setdefault(f, crc32(f.encode()) % 10_000)] += 1
        return n
    s, u = counts(r[1] for r in rows), counts(target)
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + 10_000) / ((a + 1) * (sum(u) + 10_000)))) for a, b in zip(s, u)]
    out = []
    for r in rows:
        f = features(r[1])
        weight = sum(gain[bucket[x]] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:8], 16)
        out.append([r[0], len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(r[1]))])
    long = sorted((x for x in out if x[4] >= 20), key=lambda x: (-x[3], x[0] is None, x[0] or 0, x[1]))
    drawn = long[:25 * len(long) // 100]
    return sorted(([*x[:4], n + 1] for n, x in enumerate(drawn)), key=repr) + sorted(
        ([*x[:4], None] for x in [*long[len(drawn):], *(x for x in out if x[4] < 20)]), key=repr)


def found(spark, rows, target):
    df = docs(spark, rows, ["score", "rank", "part", "nr"])
    aim = spark.createDataFrame([(x, 1) for x in target], "text string, doc_id int")
    got = [[r.doc_id, r.n_features, r.weight, r.score, r["rank"]] for r in t.resample(df, aim).collect()]
    return sorted((x for x in got if x[4]), key=repr) + sorted((x for x in got if not x[4]), key=repr)


def test_features_equal_brute_force():
    rng = random.Random(1)
    one, two, three = t.scanners(3)
    for _ in range(400):
        text = "".join(rng.choice(["a", "B", "É", "é", "7", " ", "--", "\n", "\x1c", "\x7f", "\U0001F600"]) for _ in range(rng.randrange(30)))
        got = [m[0].decode() for p in (one, two) for m in p.finditer(t.collapsed(text.encode()), overlapped=True)]
        assert got == features(text), repr(text)
        w = words(text)
        assert [m[0].decode() for m in three.finditer(t.collapsed(text.encode()), overlapped=True)] == [
            " ".join(w[i:i + 3]) for i in range(len(w) - 2)]
        assert [int(b) for f in t.feature_buckets(text.encode(), [one, two]) for b in f] == [crc32(f.encode()) % 10_000 for f in features(text)]


def test_long_words_and_texts_take_linear_time():
    import time
    began = time.time()
    assert [len(f) for f in t.feature_buckets(b"x" * 3_000_000 + b" y", t.scanners())] == [2, 1]
    assert [len(f) for f in t.feature_buckets(b"y " + b"x" * 3_000_000, t.scanners())] == [2, 1]
    assert time.time() - began < 5


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(200)] + ["über", "Да", "A1"]
    rows = [(i, rng.choice([" ", ", ", "\n"]).join(rng.choices(vocabulary, k=rng.randrange(60)))) for i in range(300)]
    target = [" ".join(rng.choices(vocabulary[:40], k=30)) for _ in range(20)]
    assert found(spark, rows, target) == brute(rows, target)


def test_ties_and_repeated_rows(spark):
    text = " ".join(f"w{i}" for i in range(30))
    rows = [(5, text)] * 300 + [(6, text), (None, text), (5, text + " w1"), (2 ** 60 + 1, text)]
    assert found(spark, rows, ["w1 w2 w3"]) == brute(rows, ["w1 w2 w3"])


def test_awkward_rows(spark):
    assert found(spark, AWKWARD, [None, "", "word1 word2"]) == brute(AWKWARD, [None, "", "word1 word2"])
    assert found(spark, AWKWARD, []) == brute(AWKWARD, [])
    assert found(spark, [], ["a b"]) == []
