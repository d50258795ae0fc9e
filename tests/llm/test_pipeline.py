"""The pipeline's stages against brute force, on planted documents and awkward rows."""

import os
import random
import tempfile
from collections import Counter, defaultdict

import corpus_pipeline
import pytest
from llm.helpers import AWKWARD, docs
from pyspark.sql import functions as F
from rateflow.llm import order_minhash, packing, quality_rules, stages


def corpus():
    rng = random.Random(12)
    rows, labels = [], []
    for i in range(240):
        words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 8))) for _ in range(rng.randrange(60, 160))]
        kind = i % 8
        if kind == 1:
            words = [w + "%%%" for w in words]           # junk that the rules catch
        elif kind == 2:
            words = [w.upper() + "!!" for w in words]    # junk for the classifier
        elif kind == 3 and rows:
            words = rows[-3][1].split()                  # a near copy of the last clean document
            words[5] = f"edit{i}"
        elif kind == 4:
            words = rows[i - 4][1].split()               # an exact copy
        rows.append((i, " ".join(words), f"s{i % 5}" if i % 5 else None))
        labels.append((i, 0 if kind in (1, 2) else 1, 0))
    return rows, labels


@pytest.fixture(scope="module")
def inputs(spark):
    base = tempfile.mkdtemp(prefix="llm-pipeline-")
    rows, labels = corpus()
    docs(spark, [*rows, *((-k - 1 if r[0] is not None else None, r[1], "odd") for k, r in enumerate(AWKWARD))]) \
        .write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    return base, rows, dict((i, q) for i, q, _ in labels)


def test_stages(spark, inputs):
    base, rows, quality = inputs
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    at = {"in": spark.read.parquet(f"{base}/documents.parquet")}
    read = at["in"]
    for name, stage in corpus_pipeline.STAGES:
        path = os.path.join(base, name)
        stage(spark, read, base).write.parquet(path)
        read = at[name] = spark.read.parquet(path)
        if name != "packing":
            assert read.columns == columns

    def texts(name):
        return {r.doc_id: r.text for r in at[name].collect()}

    ruled = texts("quality_rules")
    for r in at["in"].collect():
        n = dict(zip(quality_rules.MEASURES, quality_rules.measure(r.text)))
        bad = n["n_words"] < 50 or 2 * n["n_repeat_words"] > n["n_words"] or 10 * n["n_symbols"] > n["n_words"] \
            or not 2 * n["n_words"] <= n["word_chars"] <= 15 * n["n_words"]
        assert (r.doc_id in ruled) == (not bad)
    judged = texts("quality_classifier")
    assert set(judged) <= set(ruled)
    planted = [i for i in ruled if i is not None and i >= 0]
    assert all((i in judged) == (quality[i] == 1) for i in planted)
    kept = texts("near_dedup")
    ids = sorted(judged)
    group = {i: i for i in ids}
    pairs = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:]]
    for (a, b), same in zip(pairs, order_minhash.alike([(judged[a], judged[b]) for a, b in pairs])):
        if same:
            x, y = group[a], group[b]
            group = {i: min(x, y) if g in (x, y) else g for i, g in group.items()}
    assert sorted(kept) == sorted(set(group.values()))
    mixed = Counter(r.doc_id for r in at["mixing"].collect())
    assert set(mixed) <= set(kept) and max(mixed.values()) <= 2
    words = {i: len(kept[i].split()) for i in kept}
    assert abs(sum(words[i] * n for i, n in mixed.items()) / sum(words.values()) - 1.5) < 0.05
    whole = defaultdict(int)
    for r in at["packing"].collect():
        whole[r.doc_id] += r.length
        assert r.offset + r.length <= packing.WINDOW
    tokens = {r.doc_id: r.doc_tokens for r in at["packing"].collect()}
    assert dict(whole) == {i: tokens[i] * n for i, n in mixed.items()}


def test_run_gives_the_last_stage(spark, inputs):
    base, _, _ = inputs
    got = corpus_pipeline.run(spark, base)
    assert got.columns[:3] == ["doc_id", "start", "length"] and got.count() > 0


def test_stages_keep_extra_columns_and_empty_tables(spark, inputs):
    base, rows, _ = inputs
    more = docs(spark, rows[:40], ["node", "score", "row", "size", "failures", "class_id", "copies"])
    for stage in (stages.quality_rules_stage, stages.quality_classifier_stage, stages.near_dedup_stage, stages.mixing_stage):
        out = stage(spark, more, base)
        assert out.columns == more.columns
        assert all(r.node == r.score == r.copies == "clash" for r in out.collect())
        assert stage(spark, more.where("false"), base).count() == 0
    assert stages.packing_stage(spark, more.where("false"), base).count() == 0


def test_equal_rows_in_the_mix_are_counted_once_each(spark, inputs):
    rows = [(1, "a b c d e f", "s")] * 3 + [(2, "x y z", "s")]
    out = stages.mixing_stage(spark, docs(spark, rows), inputs[0])
    counts = Counter(r.doc_id for r in out.collect())
    assert abs(6 * counts[1] + 3 * counts[2] - 1.5 * 21) <= 6
    assert out.where(F.col("n_chars").isNull()).count() == 0
