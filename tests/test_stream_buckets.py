"""The scoring stream reads the buckets of its batch only, and its logs fold by bucket."""

import contextlib
import io
import random
import tempfile

from pyspark.sql import functions as F

from rateflow.schemas import RATING
from rateflow.sources.tables import BucketedLog, KeyedLog
from rateflow.streaming import jobs


def _plan(df):
    said = io.StringIO()
    with contextlib.redirect_stdout(said):
        df.explain("formatted")
    return said.getvalue()


def _files(df):
    return {r[0] for r in df.select(F.input_file_name()).distinct().collect()}


def test_similarities_are_read_by_product(spark):
    path = tempfile.mkdtemp(prefix="rf-sims-") + "/sims"
    rows = [(p, q, 0.7) for p in range(200) for q in range(5)]
    jobs.write_similarities(spark.createDataFrame(rows, "productId int, simProductId int, sim double"), path, 20)
    everything = spark.read.parquet(path)
    assert everything.count() == 1000 and len(_files(everything)) == 20
    for wanted, most in (([7], 1), ([7, 8, 9], 3), (list(range(200)), 20)):
        read = jobs.similarities_of(spark, path, spark.createDataFrame([(p,) for p in wanted], "productId int"))
        assert {(r.productId, r.simProductId) for r in read.collect() if r.productId in wanted} == {(p, q) for p in wanted for q in range(5)}
        assert 0 < len(_files(read)) <= most
        assert "PartitionFilters: [" in _plan(read) and "bucket_of_20" in _plan(read)
    none = jobs.similarities_of(spark, path, spark.createDataFrame([], "productId int"))
    assert none.collect() == []
    plain = tempfile.mkdtemp(prefix="rf-sims-") + "/plain"
    spark.createDataFrame(rows, "productId int, simProductId int, sim double").write.parquet(plain)
    assert jobs.similarities_of(spark, plain, spark.createDataFrame([(7,)], "productId int")).count() == 1000


def test_history_and_messages_are_read_by_user(spark):
    base = tempfile.mkdtemp(prefix="rf-hist-")
    rows = spark.createDataFrame([(u, p, 3.0, p) for u in range(100) for p in range(3)], RATING)
    jobs.write_history(rows, f"{base}/history", 10)
    seen = BucketedLog(spark, f"{base}/seen", RATING, "userId", 10)
    seen.append(rows, 0)
    seen.append(rows.withColumn("productId", F.col("productId") + 10), 1)
    for compacted in (False, True):
        if compacted:
            seen.compact(lambda r: r, 0)
        for users in ([5], [5, 6], list(range(100))):
            ids = spark.createDataFrame([(u,) for u in users], "userId int")
            past = jobs._past(spark, f"{base}/history", seen, ids, 2, 10)
            got = sorted((r.userId, r.productId) for r in past.collect())
            assert got == sorted((u, p) for u in users for p in (0, 1, 2, 0, 1, 2, 10, 11, 12))
            buckets = seen.buckets_of(ids)
            assert len(_files(seen.read(buckets, before=2))) <= 2 * len(buckets)
            assert len(buckets) <= len(users)
        # Messages of the batch itself and of later ones are not history.
        first = jobs._past(spark, f"{base}/history", seen, spark.createDataFrame([(5,)], "userId int"), 1, 10)
        assert sorted(r.productId for r in first.collect()) == [0, 0, 1, 1, 2, 2]


def test_any_reader_sees_the_whole_log(spark):
    rng = random.Random(1)
    path = tempfile.mkdtemp(prefix="rf-any-") + "/t"
    log = BucketedLog(spark, path, RATING, "userId", 8)
    kept = []
    for n in range(7):
        rows = [(rng.choice([n, n + 1, 20]), n, 1.0, rng.randrange(99)) for _ in range(6)]
        kept += rows
        log.append(spark.createDataFrame(rows, RATING), n)
        if n % 2:
            log.compact(lambda r: r, n)
        want = sorted(kept)
        for reader in (log, KeyedLog(spark, path, RATING)):
            assert sorted(map(tuple, reader.read().select(*RATING.fieldNames()).collect())) == want, (n, type(reader))
