"""Streams give the batch result for any split of the input into micro-batches."""

import os
import random
import tempfile

from pyspark.sql import functions as F

from rateflow.operators import scoring
from rateflow.sources import text
from rateflow.sources.tables import KeyedLog
from rateflow.streaming import jobs


def _write_files(spark, rows, schema, n_files, d):
    random.Random(3).shuffle(rows)
    for i in range(n_files):
        spark.createDataFrame(rows[i::n_files], schema).coalesce(1).write.parquet(f"{d}/part{i}")
    return [f"{d}/part{i}" for i in range(n_files)]


def test_recent_ratings_stream_equals_batch(spark):
    base = tempfile.mkdtemp(prefix="rf-stream-")
    rng = random.Random(5)
    rows = [(rng.randrange(6), rng.randrange(40), float(rng.randrange(1, 6)), t)
            for t in range(400)]
    schema = "userId int, productId int, score double, timestamp int"
    src = f"{base}/src"
    os.makedirs(src)
    # flat directory of files, one file per micro-batch
    for i, part in enumerate([rows[j::5] for j in range(5)]):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{base}/tmp{i}")
        for f in os.listdir(f"{base}/tmp{i}"):
            if f.endswith(".parquet"):
                os.link(f"{base}/tmp{i}/{f}", f"{src}/b{i}-{f}")
    q = jobs.start_recent_ratings(spark, src, f"{base}/state", f"{base}/ckpt",
                                  trigger={"availableNow": True}, max_files=1, compact_every=2)
    jobs.run_to_end(q)
    got = jobs.recent_from_log(KeyedLog(spark, f"{base}/state", jobs.RECENT_STATE).read())
    want = scoring.recent_ratings(spark.createDataFrame(rows, schema))
    g = sorted(tuple(r) for r in got.collect())
    w = sorted(tuple(r) for r in want.collect())
    assert g == w


def test_log_filter_stream(spark):
    base = tempfile.mkdtemp(prefix="rf-log-")
    lines = [(1, "a INFO PRODUCT_RATING_PREFIX:1|2|3.0|4\t"), (2, "b ERROR 1|2|3.0|4"),
             (3, "c PRODUCT_RATING_PREFIX:")]
    spark.createDataFrame(lines, jobs.LINE_SCHEMA).write.parquet(f"{base}/src")
    q = jobs.start_log_filter(spark, f"{base}/src", f"{base}/out", f"{base}/ckpt",
                              trigger={"availableNow": True})
    jobs.run_to_end(q)
    got = [tuple(r) for r in spark.read.parquet(f"{base}/out").collect()]
    assert got == [(1, "1|2|3.0|4")]
    batch = text.extract_rating_payloads(spark.createDataFrame(lines, jobs.LINE_SCHEMA))
    assert [tuple(r) for r in batch.collect()] == got


def _rows(df):
    out = [(r[0], r[1], r[2], None if r[3] is None else round(r[3], 9)) for r in df.collect()]
    return sorted(out, key=lambda r: (r[0], r[1] or 0))


def _stream_inputs(spark, base, rng):
    from rateflow.schemas import RATING
    sims = [(p, q, round(0.41 + rng.random() * 0.5, 3)) for p in range(12) for q in range(12)
            if p != q and rng.random() < 0.5]
    hist = [(u, rng.randrange(12), float(rng.randrange(1, 6)), t) for t in range(60)
            for u in [rng.randrange(5)]]
    spark.createDataFrame(sims, "productId int, simProductId int, sim double").write.parquet(f"{base}/sims")
    jobs.write_history(spark.createDataFrame(hist, RATING), f"{base}/history", 4)
    return sims, hist


def _feed(spark, base, nr, lines):
    """One more file for the stream."""
    spark.createDataFrame(lines, jobs.LINE_SCHEMA).coalesce(1).write.parquet(f"{base}/t{nr}")
    os.makedirs(f"{base}/src", exist_ok=True)
    for f in os.listdir(f"{base}/t{nr}"):
        if f.endswith(".parquet"):
            os.link(f"{base}/t{nr}/{f}", f"{base}/src/b{nr}-{f}")


def _run(spark, base, **more):
    q = jobs.start_stream_recs(spark, f"{base}/src", f"{base}/recs", f"{base}/ckpt",
                               sims_path=f"{base}/sims", history_path=f"{base}/history",
                               quarantine_path=f"{base}/bad", trigger={"availableNow": True}, buckets=4, **more)
    jobs.run_to_end(q)
    return jobs.recs_from_log(KeyedLog(spark, f"{base}/recs", jobs.STREAM_RECS).read())


def test_stream_recs_with_live_history(spark):
    """Micro-batches (bad lines included) give what a loop over the batches gives, in
    which the messages of a batch are history for the next ones."""
    from rateflow.schemas import RATING
    base = tempfile.mkdtemp(prefix="rf-recs-")
    rng = random.Random(11)
    sims, hist = _stream_inputs(spark, base, rng)
    msgs = [(1000 + i, rng.randrange(5), rng.randrange(12), 4.0, 200 + rng.randrange(30))
            for i in range(16)]
    random.Random(2).shuffle(msgs)
    for i in range(4):
        _feed(spark, base, i, [(e, f"{u}|{p}|{s}|{t}") for e, u, p, s, t in msgs[i::4]] + [(9990 + i, "1|2")])
    got = scoring.flat_recs(_run(spark, base, max_files=1, compact_every=2), "userId")
    assert spark.read.parquet(f"{base}/bad").count() == 4
    s = spark.read.parquet(f"{base}/sims")
    lists = None
    past = list(hist)
    for i in sorted(range(4), key=lambda k: os.path.getmtime(f"{base}/t{k}")):
        h = spark.createDataFrame(past, RATING)
        m = spark.createDataFrame([(f"{e:020d}", u, p, x, t) for e, u, p, x, t in msgs[i::4]],
                                  "event_id string, userId int, productId int, score double, timestamp int")
        recs = scoring.message_recs(m, s, h, scoring.recent_ratings(h))
        lists = recs if lists is None else lists.union(recs)
        past += [(u, p, x, t) for _, u, p, x, t in msgs[i::4]]
    assert _rows(got) == _rows(scoring.flat_recs(scoring.latest_per_user(lists), "userId"))


def test_a_rated_product_is_no_longer_recommended(spark):
    base = tempfile.mkdtemp(prefix="rf-live-")
    sims = [(1, 2, 0.9), (1, 3, 0.8), (2, 1, 0.9), (3, 1, 0.8), (2, 3, 0.7), (3, 2, 0.7)]
    spark.createDataFrame(sims, "productId int, simProductId int, sim double").write.parquet(f"{base}/sims")
    from rateflow.schemas import RATING
    jobs.write_history(spark.createDataFrame([(7, 1, 5.0, 10)], RATING), f"{base}/history", 4)
    recs = []
    for nr, line in enumerate(["7|1|5.0|20", "7|2|4.0|30", "7|1|5.0|40"]):
        _feed(spark, base, nr, [(nr, line)])
        recs.append([x.productId for r in _run(spark, base).collect() for x in r.recs])
    assert recs == [[2, 3], [3], [3]]


def test_ratings_stored_later_are_seen(spark):
    base = tempfile.mkdtemp(prefix="rf-later-")
    sims = [(1, 2, 0.9), (1, 3, 0.8), (2, 1, 0.9), (3, 1, 0.8)]
    spark.createDataFrame(sims, "productId int, simProductId int, sim double").write.parquet(f"{base}/sims")
    from rateflow.schemas import RATING
    jobs.write_history(spark.createDataFrame([(7, 1, 5.0, 10)], RATING), f"{base}/history", 4)
    _feed(spark, base, 0, [(0, "7|1|5.0|20")])
    assert [x.productId for r in _run(spark, base).collect() for x in r.recs] == [2, 3]
    jobs.write_history(spark.createDataFrame([(7, 1, 5.0, 10), (7, 3, 1.0, 11)], RATING), f"{base}/history", 4)
    _feed(spark, base, 1, [(1, "7|1|5.0|30")])
    assert [x.productId for r in _run(spark, base).collect() for x in r.recs] == [2]


def test_recent_ratings_from_messages(spark):
    base = tempfile.mkdtemp(prefix="rf-recmsg-")
    spark.createDataFrame([(1, "5|6|4.0|100"), (2, "5|7|2.0|90"), (3, "bad")], jobs.LINE_SCHEMA).write.parquet(f"{base}/src")
    q = jobs.start_recent_ratings(spark, f"{base}/src", f"{base}/state", f"{base}/ckpt",
                                  trigger={"availableNow": True}, messages=True)
    jobs.run_to_end(q)
    got = jobs.recent_from_log(KeyedLog(spark, f"{base}/state", jobs.RECENT_STATE).read())
    assert sorted(map(tuple, got.collect())) == [(5, 1, 6, 4.0), (5, 2, 7, 2.0)]


def test_equal_offsets_of_two_partitions_are_two_messages(spark):
    bus = spark.createDataFrame([("t", 0, 42, b"100|1|4.0|5"), ("t", 1, 42, b"200|1|4.0|5")],
                                "topic string, partition int, offset long, value binary")
    m, _ = text.split_good_bad(text.parse_rating_messages(jobs.bus_lines(bus)),
                               ["userId", "productId", "score", "timestamp"], keys=["event_id"])
    sims = spark.createDataFrame([(1, 5, 0.9), (1, 6, 0.8), (1, 7, 0.7)], "productId int, simProductId int, sim double")
    rated = spark.createDataFrame([(100, 7), (200, 5), (200, 6)], "userId int, productId int")
    got = {}
    for r in scoring.candidates(m, sims, rated).collect():
        got.setdefault(r.userId, []).append(r.productId)
    assert {u: sorted(p) for u, p in got.items()} == {100: [5, 6], 200: [7]}
    # The same holds for ids that are equal by mistake.
    same = m.withColumn("event_id", F.lit("x"))
    ranks = {(r.userId, r.productId): r["rank"] for r in scoring.candidates(same, sims, rated).collect()}
    assert ranks == {(100, 5): 1, (100, 6): 2, (200, 7): 1}


def test_keyed_log_compaction_reads_each_row_once(spark):
    base = tempfile.mkdtemp(prefix="rf-log-compact-")
    log = KeyedLog(spark, f"{base}/t", jobs.RECENT_STATE)
    schema = jobs.RECENT_STATE
    for b in range(4):
        log.append(spark.createDataFrame([(1, 1, 10 + b, 1.0, b), (2, 1, 20 + b, 2.0, b)], schema), b)
    def fold(df):
        return df.select(*schema.fieldNames())   # identity fold keeps every row
    log.compact(fold, 2)
    assert log.marker() == 2
    got = sorted(r.productId for r in log.read().collect())
    assert got == sorted([10 + b for b in range(4)] + [20 + b for b in range(4)])
    assert log.read().where(F.col("batch_id") == 3).count() == 2
