"""Importance resampling of documents towards a target distribution of n-grams.

A text's separators collapse to single spaces; then one overlapped regex scan per
n-gram length emits the spans: lookarounds hold a match to word boundaries, and
``overlapped=True`` starts the next match at the next word.  Each span's CRC gives its
bucket.  The scan runs once per text: its buckets, two bytes a feature, are written
to the shared folder, and both the corpus counts and the documents' weights read
them there.  Only counts, one per bucket, reach the driver.

The draw keeps the highest scores (weight plus Gumbel noise from the id), which samples
without replacement in proportion to the weights.  Ranks come from one range-partitioned
sort and the partitions' row counts, so no task holds more than its range.

Edge cases: null and empty texts have no feature and weigh 0; a null doc_id has the
noise of an empty id and comes last among ties; repeated rows are documents each, and
share the ranks of their tie in any order, being equal; empty documents or an empty
target give counts of 0 (gains stay finite); further columns are not read.
"""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from rateflow.llm.common import settled, small_batches
from rateflow.session import scratch_path

MAX_N = 2
BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 25
SEED = 7

# Bytes: A-Z in lower case, ASCII that is neither letter nor digit as a blank.
_LOWERED = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_SCANNED = "doc_id long, n_words long, n_features long, buckets binary"


def scanners(max_n: int = MAX_N) -> list:
    """Per n from 1 to ``max_n``, the pattern of n words in a row, from boundary to boundary."""
    return [regex.compile(rb"(?<![^ ])[^ ]++(?: [^ ]++){%d}(?![^ ])" % (n - 1)) for n in range(1, max_n + 1)]


def collapsed(text: bytes | None) -> bytes:
    """A text's UTF-8 bytes in lower case, words divided by single spaces."""
    return b" ".join((text or b"").translate(_LOWERED).split())


def feature_buckets(text: bytes | None, patterns: list, buckets: int = BUCKETS) -> list[np.ndarray]:
    """Per n-gram length, the bucket of every feature of a whole text."""
    words = collapsed(text)
    return [np.fromiter((crc32(m[0]) for m in p.finditer(words, overlapped=True)), np.uint32) % np.uint32(buckets)
            for p in patterns]


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_n: int = MAX_N,
         buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_words, n_features, buckets): the features of each row, packed."""
    small_batches(docs.sparkSession)
    kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")

    def run(batches):
        patterns = scanners(max_n)
        for batch in batches:
            found = [feature_buckets(t, patterns, buckets) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(f[0]) for f in found], pa.int64()),
                 pa.array([sum(map(len, f)) for f in found], pa.int64()),
                 pa.array([np.concatenate(f).astype(kind).tobytes() for f in found], pa.binary())],
                names=["doc_id", "n_words", "n_features", "buckets"])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(run, _SCANNED)


def bucket_counts(scanned: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all rows; a task sends one row per bucket at most, and so does the sum."""
    kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            packed = b"".join(batch.column(0).to_pylist())
            total += np.bincount(np.frombuffer(packed, kind), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["bucket", "n"])

    counts = scanned.select("buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    total = np.zeros(buckets, np.int64)
    for r in counts.collect():
        total[r.bucket] = r.n
    return total


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket the log ratio of target to corpus, each count one up, in floored thousandths."""
    n, s, t = len(corpus), corpus.astype(float), target.astype(float)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def weighed(scanned: DataFrame, gain: np.ndarray) -> DataFrame:
    """``scanned`` without its buckets, with ``weight``: the floored mean gain of a row's features."""
    kind = np.dtype("<u2" if len(gain) <= 1 << 16 else "<u4")

    def run(batches):
        for batch in batches:
            sums = [gain[np.frombuffer(b, kind)] for b in batch.column(3).to_pylist()]
            weights = [int(x.sum()) // len(x) if len(x) else 0 for x in sums]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(weights, pa.int64())],
                                             names=["doc_id", "n_words", "n_features", "weight"])

    return scanned.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: str = "doc_id", seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, floored, from a hash of the id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.log(-F.log((h + 0.5) / 4294967296.0)) * -1000.0)


def ranked(rows: DataFrame, min_words: int = MIN_WORDS, percent: int = PERCENT) -> DataFrame:
    """``rows`` with the rank of those drawn: the best ``percent`` of the rows with enough words.

    Rows are dealt by ranges of the whole order, a row number last, so that not even equal
    rows meet in one task; a row's place is its place in its range plus the rows before.
    """
    short = F.col("n_words") < min_words
    order = [short.asc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features")]
    apart = settled(rows.withColumn("nr", F.monotonically_increasing_id()))
    dealt = settled(apart.repartitionByRange(*order, F.col("nr")).sortWithinPartitions(*order, F.col("nr"))
                    .drop("nr").withColumn("part", F.spark_partition_id()))
    # One row per partition, whose number is a setting, not the data's size.
    parts = sorted(dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum((~short).cast("long")).alias("long")).collect())
    before = dict(zip([p.part for p in parts], np.cumsum([0] + [p.n for p in parts]).tolist()))
    drawn = sum(p.long for p in parts) * percent // 100
    names = dealt.columns

    def run(batches):
        nr = None
        for batch in batches:
            if nr is None and batch.num_rows:
                nr = before[batch.column(names.index("part"))[0].as_py()]
            places = np.arange(batch.num_rows) + (nr or 0) + 1
            nr = (nr or 0) + batch.num_rows
            rank = pa.array(places, pa.int64(), mask=places > drawn)
            yield pa.RecordBatch.from_arrays([*batch.columns, rank], names=[*names, "rank"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dealt.schema.fields)
    return dealt.mapInArrow(run, f"{fields}, rank long").drop("part")


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text", max_n: int = MAX_N,
             buckets: int = BUCKETS, min_words: int = MIN_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """Every document's (doc_id, n_words, n_features, weight, score, rank); the target's texts set the weights."""
    spark = docs.sparkSession
    path = scratch_path(spark, "features")
    scan(docs, doc_id, text, max_n, buckets).write.parquet(path)
    scanned = spark.read.parquet(path)
    aim = scan(target.select(F.lit(None).cast("long").alias(doc_id), F.col(text)), doc_id, text, max_n, buckets)
    gain = gains(bucket_counts(scanned, buckets), bucket_counts(aim, buckets))
    rows = weighed(scanned, gain).withColumn("score", F.col("weight") + noise("doc_id", seed))
    return ranked(rows, min_words, percent)


# The CRC in SQL: its table of 256 entries from the polynomial, then a fold over the bytes of
# every distinct feature.
ORACLE = rf"""
WITH RECURSIVE crc(i, c, k) AS (
  SELECT i::BIGINT, i::BIGINT, 0 FROM range(256) r(i) UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END, k + 1 FROM crc WHERE k < 8),
lookup AS (SELECT list(c ORDER BY i) AS t FROM crc WHERE k = 8),
texts AS (SELECT row_number() OVER () AS r, doc_id, text, true AS own FROM documents
          UNION ALL SELECT -row_number() OVER (), NULL, text, false FROM benchmark),
w AS (SELECT r, doc_id, own, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM texts),
f AS (SELECT r, own, unnest(list_concat(words, list_transform(range(1, len(words)),
             lambda i: words[i] || ' ' || words[i + 1]))) AS g FROM w),
names AS (SELECT g, hex(encode(g)) AS x FROM (SELECT DISTINCT g FROM f)),
b AS (SELECT g, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, len(x), 2), lambda i:
             (instr('0123456789ABCDEF', x[i]) - 1) * 16 + instr('0123456789ABCDEF', x[i + 1]) - 1)),
             lambda c, v: xor(c >> 8, t[(xor(c, v) & 255) + 1])), 4294967295::BIGINT) % {BUCKETS} AS bucket FROM names, lookup),
n AS (SELECT bucket, count(*) FILTER (own) AS s, count(*) FILTER (NOT own) AS t FROM f JOIN b USING (g) GROUP BY bucket),
gain AS (SELECT bucket, floor(ln((t + 1.0::DOUBLE) * (sum(s) OVER () + {BUCKETS}.0::DOUBLE)
             / ((s + 1.0::DOUBLE) * (sum(t) OVER () + {BUCKETS}.0::DOUBLE))) * 1000.0::DOUBLE)::BIGINT AS gain FROM n),
means AS (SELECT r, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM f JOIN b USING (g) JOIN gain USING (bucket)
          WHERE own GROUP BY r),
s AS (SELECT r, doc_id, len(words) AS n_words, greatest(2 * len(words) - 1, 0) AS n_features, coalesce(weight, 0) AS weight,
             coalesce(weight, 0) + floor(ln(-ln((('0x' || sha256('{SEED}:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT + 0.5::DOUBLE)
             / 4294967296.0::DOUBLE)) * -1000.0::DOUBLE)::BIGINT AS score FROM w LEFT JOIN means USING (r) WHERE own),
o AS (SELECT *, row_number() OVER (ORDER BY n_words < {MIN_WORDS}, score DESC, doc_id NULLS LAST, n_features) AS place,
             count(*) FILTER (n_words >= {MIN_WORDS}) OVER () AS eligible FROM s)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= eligible * {PERCENT} // 100 THEN place END AS rank FROM o
"""
