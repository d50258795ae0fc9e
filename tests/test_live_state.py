"""Recent ratings as keyed state: equal to the batch result over micro-batches and restarts."""

import os
import random
import tempfile

from pyspark.sql import functions as F

from rateflow.operators import scoring
from rateflow.schemas import RATING
from rateflow.streaming import live_state as ls


def _feed(spark, base, nr, rows, schema=RATING):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{base}/t{nr}")
    os.makedirs(f"{base}/src", exist_ok=True)
    for f in os.listdir(f"{base}/t{nr}"):
        if f.endswith(".parquet"):
            os.link(f"{base}/t{nr}/{f}", f"{base}/src/{nr:03d}-{f}")


def _run(spark, base, schema=RATING, **more):
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/src")
    q = ls.start_recent_state(spark, source, f"{base}/ckpt", trigger={"availableNow": True}, **more)
    q.awaitTermination()
    assert q.exception() is None


def _rows(df):
    return sorted(map(tuple, df.collect()))


def test_late_and_shuffled_batches_with_a_restart(spark):
    base = tempfile.mkdtemp(prefix="rf-live-")
    rng = random.Random(5)
    rows = [(rng.choice([1, 1, 1, 2, 3, 4]), rng.randrange(30), float(rng.randrange(1, 6)), rng.randrange(60)) for _ in range(500)]
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    seen = []
    for run in range(2):
        for n in range(2):
            _feed(spark, base, 2 * run + n, rows[2 * run + n::4])
        _run(spark, base, on_change=lambda lists, n: seen.append((n, {r.userId: len(r.recents) for r in lists.collect()})))
        so_far = [r for n in range(2 * run + 2) for r in rows[n::4]]
        assert _rows(ls.recent_from_state(spark, f"{base}/ckpt")) == _rows(scoring.recent_ratings(spark.createDataFrame(so_far, RATING)))
    assert [n for n, _ in seen] == [0, 1, 2, 3] and all(size <= 21 for _, lists in seen for size in lists.values())
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) == before
    some = ls.recent_from_state(spark, f"{base}/ckpt", users=spark.createDataFrame([(2,), (99,)], "userId int"))
    assert {r.userId for r in some.collect()} == {2}


def test_unchanged_lists_are_not_emitted_and_messages_are_parsed(spark):
    base = tempfile.mkdtemp(prefix="rf-live-")
    schema = "event_id long, value string"
    seen = []
    _feed(spark, base, 0, [(i, f"1|{i}|4.0|{100 + i}") for i in range(30)] + [(50, "2|7|x|1"), (51, "2|7"), (52, "2|8|3.5|9")], schema)
    _feed(spark, base, 1, [(60, "1|3|4.0|5"), (61, "2|9|1.0|10")], schema)     # user 1's row is too old for the list
    _run(spark, base, schema, on_change=lambda lists, n: seen.append(sorted(r.userId for r in lists.collect())))
    assert seen == [[1, 2], [2]]
    got = _rows(ls.recent_from_state(spark, f"{base}/ckpt"))
    assert [r[2] for r in got if r[0] == 1] == list(range(29, 8, -1)) and [r[1:] for r in got if r[0] == 2] == [(1, 9, 1.0), (2, 8, 3.5)]


def test_lists_expire(spark):
    import time

    import pytest
    base = tempfile.mkdtemp(prefix="rf-live-")
    _feed(spark, base, 0, [(1, 5, 3.0, 10)])
    source = spark.readStream.schema(RATING).parquet(f"{base}/src")
    with pytest.raises(ValueError):
        ls.start_recent_state(spark, source, f"{base}/ckpt", ttl_ms=1, trigger={"availableNow": True})
    seen = []
    q = ls.start_recent_state(spark, source, f"{base}/ckpt", ttl_ms=1, trigger={"processingTime": "1 second"},
                              on_change=lambda lists, n: seen.extend(lists.collect()))
    try:
        for nr in (1, 2):
            until = time.time() + 40
            while len(seen) < nr and time.time() < until:
                time.sleep(0.2)
            if nr == 1:
                _feed(spark, base, 1, [(1, 6, 3.0, 11)])
    finally:
        q.stop()
    assert [[x.productId for x in r.recents] for r in seen] == [[5], [6]]


def test_batches_are_cut_before_the_shuffle(spark):
    rows = spark.range(5000).select(F.lit(1).alias("userId"), (F.col("id") % 900).cast("int").alias("productId"), F.lit(2.0).alias("score"),
                                    (F.col("id") % 77).cast("int").alias("timestamp"))
    cut = ls.newest_of_batches(rows.repartition(3))
    assert cut.count() <= 21 * 3
    assert _rows(scoring.recent_ratings(cut)) == _rows(scoring.recent_ratings(rows))
    assert ls.newest_of_batches(rows.where(F.lit(False))).collect() == []


def test_small_arrow_batches_are_cut_together(spark):
    rows = spark.range(4000).select(F.lit(1).alias("userId"), F.col("id").cast("int").alias("productId"), F.lit(2.0).alias("score"),
                                    F.col("id").cast("int").alias("timestamp")).repartition(2)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "100")
    try:
        assert ls.newest_of_batches(rows).count() == 42
    finally:
        spark.conf.set(name, before)
