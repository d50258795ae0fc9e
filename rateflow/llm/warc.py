"""WARC archives and the resolution of revisits.

Archives are written by Spark's text writer: a record is a string, and the line
separator is the pair of empty lines that ends a WARC record.  They are read back as
binary files and parsed by their Content-Length.  Resolution shuffles headers only:
the first record of each payload digest is aggregated, every header is joined to it,
and the deduplicated archives are then written with fresh headers, where a revisit
record refers to the original response and carries no payload.

Edge cases: a null payload is empty; a null url leaves the target header out; control
characters in a url are percent-encoded; a null page_id leaves its header out and
comes last among equal payloads; rows that repeat page_id and payload are records of
their own, told apart by record id; an empty table gives an empty archive and result;
further columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import os
import zlib

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rateflow.llm.common import settled, small_batches
from rateflow.session import scratch_path

VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2024-01-01T00:00:00Z"
FILE_BYTES = 16 << 20   # payload bytes that an archive file holds on average
MIN_PAYLOAD = 0         # smaller payloads are never made revisits
_HEADER = ("record_id string, page_id long, url string, kind string, payload_bytes long, payload_digest string, "
           "refers_to_id string, refers_to long")


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: 40 hexadecimal digits, taken five by five to base 32."""
    digits = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digits, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.upper(F.concat(*groups)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def _field(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def _record(kind: Column, body: Column) -> Column:
    """A whole record without its end: WARC header, HTTP header and, for a response, the payload.

    Reads the columns record_id, page_id, url, payload_bytes, payload_digest,
    refers_to_id and refers_to.
    """
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n"))
    block = F.concat(http, body)
    url = F.regexp_replace(F.col("url"), "\r", "%0D")
    url = F.regexp_replace(F.regexp_replace(url, "\n", "%0A"), r"[\x00-\x1F\x7F]", "%20")
    revisit = kind == "revisit"
    return F.concat(
        F.lit(f"{VERSION}\r\n"), _field("WARC-Type", kind), _field("WARC-Record-ID", F.col("record_id")),
        _field("WARC-Target-URI", url), _field("WARC-Date", F.lit(DATE)),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _field("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _field("WARC-Refers-To", F.when(revisit, F.col("refers_to_id"))),
        _field("X-Page-Id", F.col("page_id").cast("string")),
        _field("X-Payload-Length", F.col("payload_bytes").cast("string")),
        _field("X-Refers-To-Page-Id", F.when(revisit, F.col("refers_to").cast("string"))),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        _field("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"), block)


def write_archives(records: DataFrame, path: str, mean_payload: float) -> None:
    """Write rows (kind, body and the header columns) as gzip-compressed archives.

    Files hold so many records that they come to about FILE_BYTES.
    """
    per_file = max(1, int(FILE_BYTES / max(1.0, mean_payload)))
    (records.select(_record(F.col("kind"), F.col("body")).alias("value")).write
     .option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", per_file).text(path))


def parse(archive: bytes):
    """(header dictionary, payload) of every record, by Content-Length."""
    view, at = memoryview(archive), 0
    while at < len(view):
        end = archive.index(b"\r\n\r\n", at)
        lines = archive[at:end].decode("utf-8").split("\r\n")
        if lines[0] != VERSION:
            raise ValueError(f"no WARC record at byte {at}")
        header = dict(x.split(": ", 1) for x in lines[1:])
        block = end + 4
        at = block + int(header["Content-Length"])
        body = archive.index(b"\r\n\r\n", block) + 4
        yield header, bytes(view[body:at])
        at += 4


def read_archives(spark: SparkSession, path: str, payload: bool) -> DataFrame:
    """Every record's header columns, and its payload as text if wanted.

    The digest of a response is computed from the payload that was read; that of a
    revisit is its header's.
    """
    def run(batches):
        import pyarrow as pa
        schema = [("record_id", pa.string()), ("page_id", pa.int64()), ("url", pa.string()), ("kind", pa.string()),
                  ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to_id", pa.string()),
                  ("refers_to", pa.int64())] + ([("body", pa.string())] if payload else [])

        def batch_of(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(schema)],
                                              names=[n for n, _ in schema])

        number = lambda x: None if x is None else int(x)
        for batch in batches:
            for i in range(batch.num_rows):
                # A gzip file may be made of several members.
                data, rest = b"", batch.column(0)[i].as_py()
                while rest:
                    member = zlib.decompressobj(31)
                    data += member.decompress(rest)
                    rest = member.unused_data
                rows, size = [], 0
                for h, body in parse(data):
                    response = h["WARC-Type"] == "response"
                    digest = base64.b32encode(hashlib.sha1(body).digest()).decode() if response else h["WARC-Payload-Digest"][5:]
                    rows.append((h["WARC-Record-ID"], number(h.get("X-Page-Id")), h.get("WARC-Target-URI"), h["WARC-Type"],
                                 len(body) if response else int(h["X-Payload-Length"]), digest, h.get("WARC-Refers-To"),
                                 number(h.get("X-Refers-To-Page-Id")), *([body.decode("utf-8")] if payload else [])))
                    size += len(body)
                    if len(rows) >= 500 or size > 4 << 20:
                        yield batch_of(rows)
                        rows, size = [], 0
                yield batch_of(rows)

    small_batches(spark)
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, _HEADER + (", body string" if payload else ""))


def ingest(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", payload: str = "html") -> float:
    """Write a response record per row; returns the mean payload size."""
    body = F.coalesce(F.col(payload), F.lit(""))
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), body.alias("body"))
    mean = rows.agg(F.avg(F.octet_length("body"))).first()[0] or 0.0
    none = F.lit(None).cast("string")
    # The id takes in the row's place, so that repeated rows differ.
    place = F.md5(F.concat_ws("/", F.col("page_id").cast("string"), F.md5("body"), F.monotonically_increasing_id().cast("string")))
    uuid = F.regexp_replace(place, "(.{8})(.{4})(.{4})(.{4})(.{12})", "<urn:uuid:$1-$2-$3-$4-$5>")
    write_archives(rows.select(uuid.alias("record_id"), "page_id", "url", F.lit("response").alias("kind"),
                               F.octet_length("body").cast("long").alias("payload_bytes"),
                               base32_sha1(F.col("body")).alias("payload_digest"), none.alias("refers_to_id"),
                               none.cast("long").alias("refers_to"), "body"), path, mean)
    return mean


def resolve(headers: DataFrame, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """(record_id, refers_to_id, refers_to) of the headers that repeat an earlier payload.

    The original of a digest is the record of the smallest page_id.  It is found by an
    aggregate that is summed up before the shuffle and settled before the join, in
    which Spark can then split the partition of a digest that very many headers share.
    """
    large = headers.where(F.col("payload_bytes") >= min_payload).select("record_id", "page_id", "payload_digest")
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "record_id")
    first = settled(large.groupBy("payload_digest").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("n"))
                    .where("n > 1").select("payload_digest", F.col("first.record_id").alias("refers_to_id"),
                                           F.col("first.page_id").alias("refers_to")))
    return (large.join(first, "payload_digest").where(F.col("record_id") != F.col("refers_to_id"))
            .select("record_id", "refers_to_id", "refers_to"))


def deduplicate(spark: SparkSession, source: str, target: str, mean_payload: float, min_payload: int = MIN_PAYLOAD) -> None:
    """Read archives, resolve revisits and write the deduplicated archives."""
    revisits = resolve(read_archives(spark, source, payload=False), min_payload)
    records = read_archives(spark, source, payload=True).drop("refers_to_id", "refers_to").join(revisits, "record_id", "left")
    again = F.col("refers_to_id").isNotNull()
    write_archives(records.withColumn("kind", F.when(again, F.lit("revisit")).otherwise(F.lit("response")))
                   .withColumn("body", F.when(again, F.lit("")).otherwise(F.col("body"))), target, mean_payload)


def archive_pages(pages: DataFrame, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """Write pages as archives, deduplicate these and read them back: one row per page."""
    spark = pages.sparkSession
    base = scratch_path(spark, "warc")
    raw, final = os.path.join(base, "raw"), os.path.join(base, "deduplicated")
    mean = ingest(pages, raw)
    deduplicate(spark, raw, final, mean, min_payload)
    return (read_archives(spark, final, payload=False)
            .select("page_id", "payload_bytes", "payload_digest", F.col("kind").alias("record_type"), "refers_to"))


# SQL has no base32 function, so the digest is taken digit by digit: five hexadecimal
# digits are four of base 32.
_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS hex FROM p),
g AS (SELECT page_id, payload_bytes,
             list_aggregate(list_transform(range(0, 8), lambda k:
                 list_aggregate(list_transform([15, 10, 5, 0], lambda s:
                     '{_DIGITS}'[(((('0x' || substr(hex, (k * 5 + 1)::INT, 5))::BIGINT >> s) & 31) + 1)::INT]), 'string_agg', '')),
                 'string_agg', '') AS payload_digest FROM d),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM g)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to FROM f
"""
