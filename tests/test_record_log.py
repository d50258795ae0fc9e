"""The partitioned record log as a source and a sink."""

import json
import tempfile

import pytest
from pyspark.sql import functions as F

from rateflow.sources import record_log as rl
from rateflow.streaming import jobs


@pytest.fixture
def log(spark):
    rl.register(spark)
    return tempfile.mkdtemp(prefix="rf-log-") + "/topic"


def _write(spark, path, rows, **options):
    df = spark.createDataFrame(rows, "key string, value string")
    df.write.format("record_log").option("path", path).options(partitions=3, **options).mode("append").save()


def _read(spark, path):
    return [tuple(r) for r in spark.read.format("record_log").load(path).orderBy("partition", "offset").collect()]


def _stream(spark, path, base, **options):
    return spark.readStream.format("record_log").options(**options).load(path)


def _run(frame, base, sink="out"):
    q = (frame.writeStream.format("parquet").option("path", f"{base}/{sink}").option("checkpointLocation", f"{base}/ckpt-{sink}")
         .trigger(availableNow=True).start())
    jobs.run_to_end(q)


def test_offsets_are_gapless_and_a_keys_records_stay_in_order(spark, log):
    rows = [(f"k{n % 7}", f"v{n}") for n in range(200)] + [(None, "no key"), ("", None), ("kü", "x" * 100_000)]
    _write(spark, log, rows[:120])
    _write(spark, log, rows[120:])
    got = _read(spark, log)
    assert sorted((k or "", v or "") for _, _, _, k, v in got) == sorted((k or "", v or "") for k, v in rows)
    by = {}
    for topic, partition, offset, key, value in got:
        assert topic == "topic"
        by.setdefault(partition, []).append((offset, key))
    assert set(by) == {0, 1, 2} and all([o for o, _ in x] == list(range(len(x))) for x in by.values())
    assert all(len({p for p, x in by.items() if any(k == key for _, k in x)}) == 1 for key in {k for k, _ in rows})
    assert {p for p, x in by.items() if any(k is None for _, k in x)} == {0}


def test_an_empty_log(spark, log):
    assert _read(spark, log) == []
    with pytest.raises(Exception, match="key and a value"):
        spark.range(3).write.format("record_log").option("path", log).mode("append").save()


def test_stream_restarts_where_it_stopped(spark, log):
    base = tempfile.mkdtemp(prefix="rf-")
    for part in range(3):
        _write(spark, log, [(f"k{n % 5}", f"{part}-{n}") for n in range(40)])
        _run(_stream(spark, log, base), base)
        out = spark.read.parquet(f"{base}/out")
        assert out.count() == 40 * (part + 1) == out.select("value").distinct().count()


def test_start_at_latest_or_at_given_offsets(spark, log):
    base = tempfile.mkdtemp(prefix="rf-")
    _write(spark, log, [(f"k{n}", f"old{n}") for n in range(30)])
    _run(_stream(spark, log, base, startingOffsets="latest"), base, "late")
    ends = rl.LogFiles(log).last()["ends"]
    _write(spark, log, [(f"k{n}", f"new{n}") for n in range(30)])
    _run(_stream(spark, log, base, startingOffsets="latest"), base, "late")
    assert {r.value[:3] for r in spark.read.parquet(f"{base}/late").collect()} == {"new"}
    given = {p: n - 2 for p, n in ends.items()}
    _run(_stream(spark, log, base, startingOffsets=json.dumps(given)), base, "given")
    assert spark.read.parquet(f"{base}/given").count() == 30 + 2 * len(given)


def test_rate_limit_holds_over_restarts(spark, log):
    base = tempfile.mkdtemp(prefix="rf-")
    _write(spark, log, [(f"k{n}", str(n)) for n in range(100)])
    sizes = []
    for _ in range(5):
        before = sum(sizes)
        _run(_stream(spark, log, base, maxRecordsPerTrigger=30, group="g"), base)
        sizes.append(spark.read.parquet(f"{base}/out").count() - before)
    assert sizes == [30, 30, 30, 10, 0]
    # Another limit after a restart, and new records.
    _write(spark, log, [(f"k{n}", str(100 + n)) for n in range(20)])
    _run(_stream(spark, log, base, maxRecordsPerTrigger=7, group="g"), base)
    _run(_stream(spark, log, base), base)
    values = [r.value for r in spark.read.parquet(f"{base}/out").collect()]
    assert sorted(map(int, values)) == list(range(120))
    with pytest.raises(Exception, match="needs a group"):
        _run(_stream(spark, log, base, maxRecordsPerTrigger=7), base, "other")


def test_equal_offsets_of_two_partitions_are_two_records(spark, log):
    _write(spark, log, [("a", "1|2|3.0|4"), ("b", "5|6|1.0|7"), ("c", "8|9|2.0|10"), ("d", "1|1|1.0|1")])
    lines = jobs.bus_lines(spark.read.format("record_log").load(log))
    rows = lines.collect()
    assert len({r.event_id for r in rows}) == 4 and len({r.event_id[-20:] for r in rows}) < 4


def test_a_retried_epoch_leaves_no_double_record(spark, log):
    files = rl.LogFiles(log)
    batch = lambda *kv: rl.pa.RecordBatch.from_pylist([{"key": k, "value": v} for k, v in kv], rl._RECORDS)
    written = [files.write_segments(iter([batch(("a", "1"), ("b", "2"))]), 3) for _ in range(3)]
    files.commit(written[0], "w", 0)
    files.commit(written[1], "w", 0)       # the same epoch again, after a restart
    files.commit(written[2], "other", 0)   # another writer's first epoch
    assert [v for *_, v in _read(spark, log)].count("1") == 2
    # Segments that no epoch names (a failed task's) are not read.
    files.write_segments(iter([batch(("a", "lost"))]), 3)
    assert "lost" not in [v for *_, v in _read(spark, log)]


def test_sink_of_a_stream_is_keyed_and_repeats_nothing(spark, log):
    import shutil
    base = tempfile.mkdtemp(prefix="rf-")
    rows = [(str(n), f"t INFO PRODUCT_RATING_PREFIX:{n % 4}|{n}|3.0|{n}") for n in range(40)] + [("x", "t ERROR 1|2|3.0|4")]
    _write(spark, log, rows)

    def run(ckpt):
        jobs.run_to_end(jobs.start_log_filter(spark, log, f"{base}/sink", f"{base}/{ckpt}", trigger={"availableNow": True},
                                              source_format="record_log", sink_format="record_log", sink_options={"writer": "f", "partitions": 4}))
    run("ckpt")
    got = _read(spark, f"{base}/sink")
    assert len(got) == 40 and all(value.split("|")[0] == key for *_, key, value in got)
    assert all(len({p for _, p, _, k, _ in got if k == key}) == 1 for key in "0123")
    # A checkpoint that lost its last commit runs the epoch again: nothing is added.
    shutil.copytree(f"{base}/ckpt", f"{base}/ckpt2", ignore=lambda d, names: [n for n in names if d.endswith("/commits")])
    run("ckpt2")
    assert len(_read(spark, f"{base}/sink")) == 40


def test_big_partitions_come_in_several_segments(spark, log, monkeypatch):
    monkeypatch.setattr(rl, "SEGMENT_RECORDS", 10)
    files = rl.LogFiles(log)
    for part in range(3):
        batches = (rl.pa.RecordBatch.from_pylist([{"key": "a", "value": f"{part}-{b}-{n}"} for n in range(7)], rl._RECORDS) for b in range(5))
        files.commit(files.write_segments(batches, 1), "w", part)
    pieces = files.between({"0": 33}, {"0": 80})
    assert [(p.low, p.high) for p in pieces][0][0] == 33 and pieces[-1].high == 80
    assert all(a.high == b.low for a, b in zip(pieces, pieces[1:])) and len(pieces) > 3
    values = [b.column(4)[i].as_py() for p in pieces for b in rl._records(log, p) for i in range(b.num_rows)]
    assert values == [f"{n // 35}-{n % 35 // 7}-{n % 7}" for n in range(33, 80)]
    assert spark.read.format("record_log").load(log).agg(F.count("*")).first()[0] == 105
