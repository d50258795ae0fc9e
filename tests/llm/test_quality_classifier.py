"""Classifier: held-out accuracy, determinism, awkward rows, degenerate labels."""

import random

import numpy as np
from llm.helpers import AWKWARD, docs
from rateflow.llm import quality_classifier as m

LABELS = "doc_id long, quality int, toxic int"


def corpus(n, seed=0):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 8))) for _ in range(40)]
        rows.append((i, " ".join(w + ("%%%" if bad else "") for w in words)))
        labels.append((i, 0 if bad else 1, 0))
    return rows, labels


def test_held_out_accuracy_and_reruns(spark):
    rows, labels = corpus(300)
    d, y = docs(spark, rows, ["score", "predicted"]), spark.createDataFrame(labels, LABELS)
    got = {r.doc_id: r for r in m.classify(d, y).collect()}
    truth = {i: q for i, q, _ in labels}
    held = [i for i in got if got[i].held_out]
    assert 60 < len(held) < 140
    assert sum(got[i].predicted == truth[i] for i in held) / len(held) > 0.97
    again = {r.doc_id: r.score for r in m.classify(d.repartition(5), y.repartition(3)).collect()}
    assert all(abs(again[i] - got[i].score) < 1e-9 for i in got)


def test_no_label_of_a_held_out_row_is_used(spark):
    rows, labels = corpus(120)
    d = docs(spark, rows)
    y = spark.createDataFrame(labels, LABELS)
    flipped = y.withColumn("quality", m.F.when(m.held_out(m.F.col("doc_id")), 1 - m.F.col("quality")).otherwise(m.F.col("quality")))
    a, b = m.train(d, y), m.train(d, flipped)
    assert np.array_equal(a[0], b[0]) and a[1] == b[1]


def test_awkward_rows_and_degenerate_labels(spark):
    d = docs(spark, AWKWARD)
    none = spark.createDataFrame([], LABELS)
    got = m.classify(d, none).collect()
    assert len(got) == len(AWKWARD) and {r.score for r in got} == {0.5}
    assert [r.held_out for r in got if r.doc_id is None] == [False]
    one = spark.createDataFrame([(4, 1, 0), (5, None, 0), (None, 0, 0), (999, 0, 0), (4, 0, 0)], LABELS)
    assert all(0 <= r.score <= 1 for r in m.classify(d, one).collect())
    assert m.classify(docs(spark, []), one).collect() == []


def test_features_are_those_of_each_word():
    def slow(text):
        words = text.split()
        return sum(1 + max(0, len(w)) + max(0, len(w) - 1) for w in words) + len(words) - 1
    for t in ("a", "abc de", "  x  yy\nzzz ", "é" * 70):
        assert len(m.buckets(t)) == slow(t)
    assert len(m.buckets("")) == len(m.buckets(" \n")) == 0
    assert m.buckets("same same")[0] == 0  # a repeated word's pair


def test_a_repeated_id_reaches_the_driver_once(spark, monkeypatch):
    rows, labels = corpus(60)
    hot = next(i for i, _ in rows if not spark.range(i, i + 1).select(m.held_out(m.F.col("id"))).first()[0])
    many = rows + [(hot, f"z {k} copy") for k in range(500)]
    collected, collect = [], type(spark.range(1)).collect

    def counted(df):
        out = collect(df)
        collected.append(len(out))
        return out
    d, y = docs(spark, many), spark.createDataFrame(labels, LABELS)
    monkeypatch.setattr(type(d), "collect", counted)
    seen = []
    monkeypatch.setattr(m, "fit", lambda examples: seen.append(examples))
    m.train(d, y)
    assert max(collected) <= 60 and len(seen[0]) == max(collected)
    assert (min(t for i, t in many if i == hot), dict((i, q) for i, q, _ in labels)[hot]) in seen[0]
