"""Repeated lines across documents: all but the first document's go.

Every line with a long enough key becomes a row of hashes: the key's 128 bits, the
document and the line's position.  The rows are range-partitioned by all of these and
sorted, so a line that a third of all documents share spreads over many partitions.  A
stream over each sorted partition finds the first document of every key; a key that
continues from the partition before takes its first document from there (one row of
summary per partition).  What comes back is small: a compressed bitmap of the kept lines
per document that loses some.  Texts are read again only where somebody wants them.

A document is its doc_id: rows of one doc_id never take lines from each other.

Edge cases: a null or empty text is one empty line, kept; a null doc_id is an id of
its own, after all others; repeated rows lose the same lines; equal lines of one
document stay or go together; an empty table gives an empty result; columns of any
name pass through ``apply_bitmaps``.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from rateflow.llm.common import append_columns, settled, small_batches

WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_CHARS = 10
_SUMMARY = "part int, first1 long, first2 long, last1 long, last2 long, no_id boolean, id long, whole boolean"


def line_key(line: Column) -> Column:
    """What makes two lines equal: the line without outer white space, A-Z in lower case."""
    inner = F.btrim(line, F.lit(WHITE))
    # On ASCII alone, which the two lengths tell, the faster built-in does the same.
    return F.when(F.octet_length(inner) == F.char_length(inner), F.lower(inner)).otherwise(F.translate(inner, UPPER, LOWER))


def _digest(column: Column) -> list[Column]:
    """128 bits of a string, as two longs."""
    return [F.xxhash64(column), F.xxhash64(F.lit(1), column)]


def hashed_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """(h1, h2, id, t1, t2, n_lines, at, nr) per line whose key has ``min_chars`` code points."""
    t1, t2 = _digest(F.coalesce(F.col(text), F.lit("")))
    lines = docs.select(F.col(doc_id).cast("long").alias("id"), t1.alias("t1"), t2.alias("t2"),
                        F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1).alias("lines"))
    each = lines.select("id", "t1", "t2", F.size("lines").alias("n_lines"), F.posexplode("lines").alias("at", "line"))
    keyed = each.withColumn("key", line_key(F.col("line"))).where(F.char_length("key") >= min_chars)
    h1, h2 = _digest(F.col("key"))
    return keyed.select(h1.alias("h1"), h2.alias("h2"), "id", "t1", "t2", "n_lines", "at",
                        F.monotonically_increasing_id().alias("nr"))


def _columns(batch) -> tuple[np.ndarray, ...]:
    """h1, h2, whether the id is null, and the id (0 if null) of a sorted batch."""
    ids = batch.column(2)
    return (batch.column(0).to_numpy(), batch.column(1).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False),
            ids.fill_null(0).to_numpy())


def summaries(lines: DataFrame) -> DataFrame:
    """One row per non-empty sorted partition: its first and last key, the document that the last
    key starts with there, and whether the partition is one key as a whole."""
    def run(batches):
        from pyspark import TaskContext
        first = last = head = None
        runs = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            h1, h2, no_id, ids = _columns(batch)
            starts = np.flatnonzero((h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])) + 1
            new = last != (h1[0], h2[0])
            runs += len(starts) + int(new)
            if len(starts) or new:
                at = starts[-1] if len(starts) else 0
                head = (bool(no_id[at]), int(ids[at]))
            first = (h1[0], h2[0]) if first is None else first
            last = (h1[-1], h2[-1])
        if first is not None:
            row = [TaskContext.get().partitionId(), *map(int, first), *map(int, last), *head, runs == 1]
            types = [pa.int32(), *[pa.int64()] * 4, pa.bool_(), pa.int64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)],
                                             names=[f.split()[0] for f in _SUMMARY.split(", ")])

    return lines.select("h1", "h2", "id").mapInArrow(run, _SUMMARY)


def carried(parts: list) -> dict[int, tuple]:
    """Per partition whose first key began before it: (key, document that the key starts with)."""
    found, open_key, head = {}, None, None
    for p in sorted(parts, key=lambda p: p.part):
        if open_key == (p.first1, p.first2):
            found[p.part] = (open_key, head)
            if p.whole:
                continue
        open_key, head = (p.last1, p.last2), (p.no_id, p.id)
    return found


def repeated_lines(lines: DataFrame) -> DataFrame:
    """(id, t1, t2, n_lines, at) of each line whose key an earlier document holds."""
    order = [F.col("h1"), F.col("h2"), F.col("id").asc_nulls_last(), F.col("at"), F.col("t1"), F.col("t2")]
    # The row number keeps the partitions even where rows are equal; it decides nothing.
    dealt = settled(lines.repartitionByRange(*order, F.col("nr")).sortWithinPartitions(*order))
    carry = carried(summaries(dealt).collect())
    names = ["id", "t1", "t2", "n_lines", "at"]

    def run(batches):
        from pyspark import TaskContext
        last, head = carry.get(TaskContext.get().partitionId(), (None, None))
        for batch in batches:
            if not batch.num_rows:
                continue
            h1, h2, no_id, ids = _columns(batch)
            starts = np.concatenate(([True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])))
            of = np.cumsum(starts) - 1
            at = np.flatnonzero(starts)
            first_no_id, first_id = no_id[at], ids[at]
            if last == (h1[0], h2[0]):
                first_no_id[0], first_id[0] = head
            drop = (first_no_id[of] != no_id) | (first_id[of] != ids)
            last, head = (h1[-1], h2[-1]), (first_no_id[-1], first_id[-1])
            yield batch.select(names).filter(pa.array(drop))

    return dealt.drop("nr").mapInArrow(run, "id long, t1 long, t2 long, n_lines int, at int")


def pack_bits(n_lines: int, dropped: list[int]) -> bytes:
    """A compressed bitmap of ``n_lines`` bits, 0 for the dropped lines."""
    keep = np.ones(n_lines, bool)
    keep[dropped] = False
    return zlib.compress(np.packbits(keep).tobytes(), 1)


def unpack_bits(n_lines: int, packed: bytes | None) -> np.ndarray:
    """The kept lines of a document; without a bitmap all are kept."""
    if packed is None:
        return np.ones(n_lines, bool)
    return np.unpackbits(np.frombuffer(zlib.decompress(packed), np.uint8), count=n_lines).astype(bool)


def keep_bitmaps(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """(id, t1, t2, n_lines, n_dropped, keep): a bitmap per document text that loses lines.

    (t1, t2) are 128 bits of the whole text, which with the id name a row without
    carrying its text; a document without a row here keeps all its lines.  A
    document's lines meet in one task, as its text does.
    """
    gone = repeated_lines(hashed_lines(docs, doc_id, text, min_chars))
    # Equal rows of one text collapse in the map tasks already, before the shuffle.
    lists = gone.distinct().groupBy("id", "t1", "t2", "n_lines").agg(F.collect_list("at").alias("dropped"))

    def start():
        def step(batch):
            return [[len(d) for d in batch.column(4).to_pylist()],
                    [pack_bits(n, d) for n, d in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())]]
        return step

    fields = [T.StructField("n_dropped", T.LongType()), T.StructField("keep", T.BinaryType())]
    return append_columns(lists, fields, start).drop("dropped")


def _beside_bitmaps(docs: DataFrame, bitmaps: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``docs`` with positional column names, followed by each row's bitmap or null."""
    rows = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    own_id, own_text = (F.col(f"c{docs.columns.index(c)}") for c in (doc_id, text))
    t1, t2 = _digest(F.coalesce(own_text, F.lit("")))
    same = own_id.cast("long").eqNullSafe(F.col("id")) & (t1 == F.col("t1")) & (t2 == F.col("t2"))
    return rows.join(bitmaps.select("id", "t1", "t2", "keep"), same, "left").select(*rows.columns, "keep")


def _kept(text: str | None, packed: bytes | None) -> tuple[int, int, str]:
    """Lines, dropped lines and the kept text."""
    lines = (text or "").split("\n")
    if packed is None:
        return len(lines), 0, text or ""
    keep = unpack_bits(len(lines), packed)
    return len(lines), int(len(lines) - keep.sum()), "\n".join(x for x, k in zip(lines, keep) if k)


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with each text cut down to its kept lines (a null text stays null)."""
    at = docs.columns.index(text)
    schema = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(docs.schema.fields)])
    small_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            kept = [None if t is None else _kept(t, packed)[2]
                    for t, packed in zip(batch.column(at).to_pylist(), batch.column(len(schema)).to_pylist())]
            columns = [*batch.columns[:at], pa.array(kept, batch.schema.field(at).type), *batch.columns[at + 1:len(schema)]]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return _beside_bitmaps(docs, bitmaps, doc_id, text).mapInArrow(run, schema).toDF(*docs.columns)


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept_sha256) of every document."""
    rows = docs.select("doc_id", "text")
    small_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            found = [_kept(t, packed) for t, packed in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64()),
                 pa.array([hashlib.sha256(f[2].encode()).hexdigest() for f in found], pa.string())],
                names=["doc_id", "n_lines", "n_dropped", "kept_sha256"])

    beside = _beside_bitmaps(rows, keep_bitmaps(rows), "doc_id", "text")
    return beside.mapInArrow(run, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS nr FROM d),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key FROM l),
f AS (SELECT *, length(key) < {MIN_CHARS} OR doc_id IS NOT DISTINCT FROM (min(doc_id) OVER (PARTITION BY key)) AS keep FROM k)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (NOT keep) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY nr) FILTER (keep), '')) AS kept_sha256
FROM f GROUP BY r
"""
