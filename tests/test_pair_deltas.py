"""Co-rating kept up to date: changes equal a full count, for any split, order, removal and retry."""

import random
import tempfile
from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from rateflow.operators import itemcf
from rateflow.operators.pair_deltas import pair_changes, square_changes
from rateflow.schemas import RATING
from rateflow.sources.tables import BucketedLog
from rateflow.streaming.co_rating import CoRating, start_co_rating

WEIGHTS = "g int, i int, w long"


def _pairs(weights):
    """Brute force: sum of products per item pair, self pairs too."""
    out = Counter()
    for (g, i), w in weights.items():
        for (h, j), v in weights.items():
            if g == h and i <= j:
                out[i, j] += w * v
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(old=st.dictionaries(st.tuples(st.integers(0, 3), st.integers(0, 6)), st.integers(1, 3), max_size=20),
       new=st.dictionaries(st.tuples(st.integers(0, 4), st.integers(0, 7)), st.integers(-2, 3), max_size=12),
       block=st.sampled_from([1, 2, 100]))
def test_changes_equal_the_difference_of_full_counts(spark, old, new, block):
    frame = lambda d: spark.createDataFrame([(*k, w) for k, w in d.items()], WEIGHTS)
    after = Counter(old)
    after.update(new)
    a, b = _pairs(after), _pairs(old)
    want = {k: a[k] - b[k] for k in a.keys() | b.keys() if a[k] != b[k]}
    got = {(r.item1, r.item2): r.change for r in pair_changes(frame(new), frame(old), "g", "i", "w", block_items=block).collect()}
    own = {(r.i, r.i): r.change for r in square_changes(frame(new), frame(old), "g", "i", "w").collect()}
    assert got | own == want


def _ratings(spark, rows):
    return spark.createDataFrame([(u, p, 3.0, t) for t, (u, p) in enumerate(rows)], RATING)


def _table(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("compact_after", [None, 0, 1])
def test_batches_removals_and_retries_equal_a_full_count(spark, compact_after):
    rng = random.Random(2)
    rows = [(rng.randrange(6), rng.randrange(9)) for _ in range(120)] + [(7, p) for p in range(40)]
    store = CoRating(spark, tempfile.mkdtemp(prefix="rf-co-"), buckets=4)
    parts = [rows[:50], rows[50:110], rows[110:]]
    for n, part in enumerate(parts):
        store.add(_ratings(spark, part), n)
        if n == 1:
            store.add(_ratings(spark, part), n)     # a retried batch counts once
        if n == compact_after:
            store.compact(n)
            store.compact(n)
    everything = _ratings(spark, rows)
    assert _table(store.cooccurrence()) == _table(itemcf.cooccurrence(everything))
    assert _table(store.top_neighbours()) == _table(itemcf.top_neighbours(everything))
    gone = rows[20:70]
    store.add(_ratings(spark, gone).withColumn("sign", F.lit(-1)), 3, sign="sign")
    left = _ratings(spark, rows[:20] + rows[70:])
    assert _table(store.cooccurrence()) == _table(itemcf.cooccurrence(left))
    store.compact(3)
    assert _table(store.cooccurrence()) == _table(itemcf.cooccurrence(left))


def test_a_batch_reads_the_buckets_of_its_users_only(spark):
    store = CoRating(spark, tempfile.mkdtemp(prefix="rf-co-"), buckets=16)
    store.add(_ratings(spark, [(u, p) for u in range(64) for p in range(3)]), 0)
    one = spark.createDataFrame([(5,)], "userId int")
    for _ in range(2):
        read = store._rated.read(store._rated.buckets_of(one), before=1)
        assert 0 < len(read.inputFiles()) and len({f.split("bucket=")[1].split("/")[0] for f in _scanned(read)}) == 1
        store.compact(0)


def _scanned(df):
    return [r[0] for r in df.select(F.input_file_name()).distinct().collect()]


def test_buckets_fold_on_their_own(spark):
    log = BucketedLog(spark, tempfile.mkdtemp(prefix="rf-bl-"), RATING, "userId", 4)
    fold = lambda rows: rows.groupBy("userId").agg(F.max("productId").alias("productId"), F.max("score").alias("score"),
                                                   F.max("timestamp").alias("timestamp")).where("score > 0")
    rows = lambda *us: spark.createDataFrame([(u, t, s, t) for u, t, s in us], RATING)
    log.append(rows((1, 1, 1.0), (2, 1, 1.0), (3, 1, 1.0), (4, 1, 1.0), (5, 1, 1.0)), 0)
    log.compact(fold, 0)
    log.append(rows((1, 2, 2.0)), 1)
    log.compact(fold, 1)
    bucket = {r.userId: r.b for r in rows((1, 0, 0.0), (2, 0, 0.0), (3, 0, 0.0), (4, 0, 0.0), (5, 0, 0.0)).withColumn("b", log.bucket()).collect()}
    names = log._folded(log._marked())
    newest = max(names.values())
    assert names[bucket[1]] == newest and any(n < newest for n in names.values())   # the others were left alone
    got = lambda: {(r.userId, r.productId) for r in fold(log.read()).collect()}
    assert got() == {(1, 2), (2, 1), (3, 1), (4, 1), (5, 1)}
    # A bucket whose rows all fold away stays empty, and older snapshots stay while they are needed.
    gone = [u for u in bucket if bucket[u] == bucket[1]]
    zero = lambda keep: (lambda df: fold(df).where(~F.col("userId").isin(gone) if keep else F.lit(True)))
    log.append(rows(*[(u, 3, 3.0) for u in gone]), 2)
    log.compact(zero(True), 2)
    log.append(rows((2, 4, 1.0)), 3)
    log.compact(fold, 3)
    log.append(rows((2, 5, 1.0)), 4)
    log.compact(fold, 4)
    assert got() == {(u, 1) for u in bucket if u not in gone and u != 2} | {(2, 5)} - {(u, 5) for u in gone}


def test_stream_equals_batch(spark):
    import os
    base = tempfile.mkdtemp(prefix="rf-costream-")
    rng = random.Random(4)
    rows = [(rng.randrange(5), rng.randrange(8)) for _ in range(90)]
    os.makedirs(f"{base}/src")
    for n in range(3):
        _ratings(spark, rows[n::3]).coalesce(1).write.parquet(f"{base}/t{n}")
        for f in os.listdir(f"{base}/t{n}"):
            if f.endswith(".parquet"):
                os.link(f"{base}/t{n}/{f}", f"{base}/src/{n}-{f}")
    store = CoRating(spark, f"{base}/store", buckets=4)
    source = spark.readStream.schema(RATING).option("maxFilesPerTrigger", 1).parquet(f"{base}/src")
    q = start_co_rating(store, source, f"{base}/ckpt", {"availableNow": True}, compact_every=2)
    q.awaitTermination()
    assert q.exception() is None
    assert _table(store.cooccurrence()) == _table(itemcf.cooccurrence(_ratings(spark, rows)))
