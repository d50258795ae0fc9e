"""WARC: exact round trip, revisits, awkward payloads."""

import base64
import hashlib
import os

from pyspark.sql import functions as F
from rateflow.llm import warc as w
from rateflow.session import scratch_path

PAGES = "page_id long, url string, html string"
TRICKY = "\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
ROWS = [(5, "http://a/", "same"), (3, "http://b/", "same"), (9, "http://c/", "same"), (1, None, None), (2, "u\r\nX: y", ""),
        (4, "http://d/é", TRICKY), (6, "http://e/", TRICKY), (7, "h", "\U0001F600 é\x00\x1f"), (8, "", "z" * 300_000),
        (None, "n", "no id"), (None, "n", "same"), (10, "x", "﻿bom\r"), (11, "y", "line\n")]


def digest(t):
    return base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()


def expected(rows):
    first = {}
    for i, _, t in rows:
        k = digest(t)
        if i is not None:
            first[k] = min(first.get(k, i), i)
    return sorted(((i, len((t or "").encode()), digest(t), "response" if i == first.get(digest(t), i) else "revisit",
                    None if i == first.get(digest(t), i) else first[digest(t)]) for i, _, t in rows), key=repr)


def test_pages_come_back(spark):
    pages = spark.createDataFrame(ROWS, PAGES).withColumn("record_id", F.lit("clash")).withColumn("payload_bytes", F.lit(1))
    got = sorted((tuple(r) for r in w.archive_pages(pages).collect()), key=repr)
    assert got == expected(ROWS)


def test_archives_hold_every_payload_once(spark):
    pages = spark.createDataFrame(ROWS, PAGES).repartition(3)
    base = scratch_path(spark, "warc-test")
    raw, final = os.path.join(base, "raw"), os.path.join(base, "final")
    mean = w.ingest(pages, raw)
    back = w.read_archives(spark, raw, payload=True).collect()
    assert sorted((r.page_id or -1, r.body) for r in back) == sorted((i or -1, t or "") for i, _, t in ROWS)
    assert len({r.record_id for r in back}) == len(ROWS)
    w.deduplicate(spark, raw, final, mean)
    kept = [r for r in w.read_archives(spark, final, payload=True).collect() if r.kind == "response"]
    assert sorted(r.body for r in kept) == sorted({t or "" for _, _, t in ROWS})
    revisit = next(r for r in w.read_archives(spark, final, payload=True).collect() if r.kind == "revisit")
    assert revisit.body == "" and revisit.refers_to_id in {r.record_id for r in kept}


def test_small_payloads_may_stay(spark):
    pages = spark.createDataFrame(ROWS, PAGES)
    got = {(r.page_id, r.record_type) for r in w.archive_pages(pages, min_payload=5).collect()}
    assert (5, "response") in got and (9, "response") in got and (6, "revisit") in got


def test_repeated_rows_and_empty_table(spark):
    rows = [(1, "u", "x"), (1, "u", "x"), (2, "v", "x")]
    got = sorted((r.page_id, r.record_type, r.refers_to) for r in w.archive_pages(spark.createDataFrame(rows, PAGES)).collect())
    assert got == [(1, "response", None), (1, "revisit", 1), (2, "revisit", 1)]
    assert w.archive_pages(spark.createDataFrame([], PAGES)).collect() == []
