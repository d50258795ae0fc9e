"""Structured Streaming jobs.

* ``start_log_filter``  -- log lines -> rating payloads (stateless; file sink,
  exactly-once through the sink's commit log).
* ``start_recent_ratings`` -- ratings or rating messages -> newest 21 per user.
* ``start_stream_recs`` -- rating messages -> rescored similar products,
  last list per user kept; every message also becomes history for later ones.

The stateful jobs keep their state as append-only keyed logs in the shared
folder (``KeyedLog``).  In ``foreachBatch`` each micro-batch is first reduced
with set operations -- newest 21 per user through a partial window limit,
latest list per user through a map-side combined ``max(struct)`` -- so a very
active user never lands whole in one task, and only the reduced rows are
appended under ``batch_id``.  Writes cost O(batch); a retried batch replaces
its own rows and reads only rows of earlier batches, so results are
exactly-once and survive lost executors and driver restarts from the
checkpoint.  Compaction folds batches before the current one, which are
committed.  Readers fold the log with the same reduction (``recent_from_log``,
``recs_from_log``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rateflow.functions.exprs import RECENT_RATINGS
from rateflow.operators import scoring
from rateflow.operators.topk import top_k_per_group
from rateflow.schemas import RATING, RECOMMENDATION
from rateflow.sources import record_log, text
from rateflow.session import shared_dir
from rateflow.sources.tables import BucketedLog, KeyedLog

LINE_SCHEMA = "event_id bigint, value string"
# Micro-batches between two compactions of a stream's keyed log.
COMPACT_EVERY = 100
# User buckets of the stored history.
HISTORY_BUCKETS = 64
# Product buckets of the similarity table.
SIMILARITY_BUCKETS = 64

RECENT_STATE = T.StructType([
    T.StructField("userId", T.IntegerType()),
    T.StructField("rank", T.IntegerType()),
    T.StructField("productId", T.IntegerType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("timestamp", T.IntegerType()),
])

STREAM_RECS = T.StructType([
    T.StructField("userId", T.IntegerType()),
    T.StructField("timestamp", T.IntegerType()),
    T.StructField("event_id", T.StringType()),
    T.StructField("recs", T.ArrayType(RECOMMENDATION)),
])


def _source(spark: SparkSession, path: str, schema, max_files: int | None,
            fmt: str = "parquet", options: dict | None = None) -> DataFrame:
    """A file source by default.  With ``fmt='kafka'`` (package on the classpath)
    ``path`` is ignored and ``options`` carry the servers, the topic, starting
    offsets and the rate limit (``maxOffsetsPerTrigger``); with ``fmt='record_log'``
    ``path`` is the log's folder and ``options`` are those of ``record_log``.  A record becomes
    (event_id, value), its id made of topic, partition and offset, as offsets
    alone repeat between partitions."""
    r = spark.readStream.format(fmt).options(**(options or {}))
    if fmt == "kafka":
        return bus_lines(r.load())
    if fmt == "record_log":
        record_log.register(spark)
        return bus_lines(r.load(path))
    r = r.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path)


def bus_lines(records: DataFrame) -> DataFrame:
    """Bus records (topic, partition, offset, value) -> (event_id, value)."""
    place = F.concat_ws("/", "topic", _ordered("partition"), _ordered("offset"))
    return records.select(place.alias("event_id"), F.col("value").cast("string").alias("value"))


def _ordered(number: str) -> F.Column:
    """A non-negative number as text that sorts like it."""
    return F.lpad(F.col(number).cast("string"), 20, "0")


def _trigger(w, trigger: dict | None):
    return w.trigger(**(trigger or {"processingTime": "2 seconds"}))


def start_log_filter(spark: SparkSession, source: str, sink: str, checkpoint: str,
                     trigger: dict | None = None, max_files: int | None = None,
                     source_format: str = "parquet",
                     source_options: dict | None = None, sink_format: str = "parquet",
                     sink_options: dict | None = None) -> StreamingQuery:
    """Log lines -> rating payloads.  With ``sink_format='kafka'`` or ``'record_log'`` records
    are keyed by the user id (first payload field), so they spread over the topic's
    partitions instead of all hashing to one, and a user's stay in order."""
    lines = _source(spark, source, LINE_SCHEMA, max_files, source_format, source_options)
    out = text.extract_rating_payloads(lines)
    if sink_format in ("kafka", "record_log"):
        out = out.select(F.split("value", "\\|").getItem(0).alias("key"), "value")
        w = out.writeStream.format(sink_format).options(**(sink_options or {}))
        if sink_format == "record_log":
            record_log.register(spark)
            w = w.option("path", sink)
    else:
        w = out.writeStream.format(sink_format).option("path", sink)
    w = w.option("checkpointLocation", checkpoint).outputMode("append")
    return _trigger(w, trigger).start()


def _recent_order():
    return [F.col("timestamp").desc(), F.col("productId").asc(), F.col("score").desc()]


def start_recent_ratings(spark: SparkSession, source: str, table_path: str, checkpoint: str,
                         k: int = RECENT_RATINGS, trigger: dict | None = None,
                         max_files: int | None = None, compact_every: int = COMPACT_EVERY,
                         messages: bool = False, source_format: str = "parquet",
                         source_options: dict | None = None) -> StreamingQuery:
    """Rating rows (userId, productId, score, timestamp), or with ``messages`` the
    bus's lines -> log of per-batch newest-k rows per user; ``recent_from_log``
    gives the newest k overall."""
    log = KeyedLog(spark, table_path, RECENT_STATE)

    def fold(rows: DataFrame) -> DataFrame:
        top = top_k_per_group(rows.select(*RATING.fieldNames()), ["userId"], _recent_order(), k)
        return top.select(*RECENT_STATE.fieldNames())

    def step(batch: DataFrame, batch_id: int) -> None:
        if messages:
            batch, _ = text.split_good_bad(text.parse_rating_messages(batch), RATING.fieldNames())
        if compact_every and batch_id and batch_id % compact_every == 0:
            log.compact(fold, batch_id - 1)
        log.append(fold(batch), batch_id)

    src = _source(spark, source, LINE_SCHEMA if messages else RATING, max_files, source_format, source_options)
    w = src.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()


def recent_from_log(log: DataFrame, k: int = RECENT_RATINGS) -> DataFrame:
    """(userId, rank, productId, score): newest k per user over the whole log."""
    top = top_k_per_group(log.select(*RATING.fieldNames()), ["userId"], _recent_order(), k)
    return top.select("userId", "rank", "productId", "score")


def _bucket(buckets: int) -> F.Column:
    return F.pmod(F.hash("userId"), F.lit(buckets))


def write_history(ratings: DataFrame, path: str, buckets: int = HISTORY_BUCKETS) -> None:
    """Stored ratings in user buckets, so that a micro-batch reads those of its users."""
    (ratings.select(*RATING.fieldNames(), _bucket(buckets).alias("bucket"))
     .write.mode("overwrite").partitionBy("bucket").parquet(path))


_SIM_BUCKET = "bucket_of_"


def write_similarities(sims: DataFrame, path: str, buckets: int = SIMILARITY_BUCKETS) -> None:
    """Similar pairs in buckets of the product, sorted by it inside, so that a micro-batch reads
    those of its products.  The number of buckets is part of the partition column's name."""
    (sims.select("productId", "simProductId", "sim", F.pmod(F.hash("productId"), F.lit(buckets)).alias(f"{_SIM_BUCKET}{buckets}"))
     .repartition(buckets, f"{_SIM_BUCKET}{buckets}").sortWithinPartitions("productId")
     .write.mode("overwrite").partitionBy(f"{_SIM_BUCKET}{buckets}").parquet(path))


def similarities_of(spark: SparkSession, path: str, products: DataFrame) -> DataFrame:
    """(productId, simProductId, sim) with all rows of the given products: of a table of ``write_similarities``
    the products' buckets are read, of any other table all rows."""
    sims = spark.read.parquet(path)
    column = next((c for c in sims.columns if c.startswith(_SIM_BUCKET)), None)
    if column:
        of = F.pmod(F.hash("productId"), F.lit(int(column[len(_SIM_BUCKET):])))
        sims = sims.where(F.col(column).isin([r[0] for r in products.select(of).distinct().collect()]))
    return sims.select("productId", "simProductId", "sim")


def recs_log(spark: SparkSession, path: str, buckets: int = HISTORY_BUCKETS) -> BucketedLog:
    """The lists that ``start_stream_recs`` writes, in user buckets."""
    return BucketedLog(spark, path, STREAM_RECS, "userId", buckets)


def _past(spark: SparkSession, history_path: str, seen: BucketedLog, users: DataFrame, batch_id: int,
          buckets: int) -> DataFrame:
    """Ratings of the given users, stored or from messages of earlier batches, from the users' buckets."""
    wanted = [r[0] for r in users.select(_bucket(buckets)).distinct().collect()]  # at most ``buckets``
    stored = spark.read.parquet(history_path).where(F.col("bucket").isin(wanted))
    earlier = seen.read(seen.buckets_of(users), before=batch_id)
    return (stored.select(*RATING.fieldNames()).unionByName(earlier.select(*RATING.fieldNames()))
            .join(users, "userId", "left_semi"))


def start_stream_recs(spark: SparkSession, source: str, table_path: str, checkpoint: str,
                      sims_path: str, history_path: str, quarantine_path: str,
                      trigger: dict | None = None,
                      max_files: int | None = None, source_format: str = "parquet",
                      source_options: dict | None = None,
                      compact_every: int = COMPACT_EVERY, buckets: int = HISTORY_BUCKETS) -> StreamingQuery:
    """Message lines (event_id, value='u|p|score|ts') -> StreamRecs table.

    The similarity table (``write_similarities``) and the history (``write_history``) are
    read anew in every micro-batch, but only in the buckets of the batch's products,
    candidates and users.  Messages of earlier batches count as history too: they are
    kept in a log beside the output.  Both logs lie in user buckets; a compaction rewrites those
    that have grown.
    """
    shared_dir(spark)
    log = recs_log(spark, table_path, buckets)
    seen = BucketedLog(spark, table_path.rstrip("/") + "_ratings", RATING, "userId", buckets)

    def step(batch: DataFrame, batch_id: int) -> None:
        if compact_every and batch_id and batch_id % compact_every == 0:
            log.compact(latest_recs, batch_id - 1)
            seen.compact(lambda rows: rows, batch_id - 1)
        if dict(batch.dtypes)["event_id"] != "string":
            batch = batch.withColumn("event_id", _ordered("event_id"))
        parsed = text.parse_rating_messages(batch).persist()
        try:
            good, bad = text.split_good_bad(parsed, RATING.fieldNames(), keys=["event_id"])
            bad.write.mode("overwrite").parquet(f"{quarantine_path}/batch={batch_id}")
            users = good.select("userId").distinct()
            past = _past(spark, history_path, seen, users, batch_id, buckets)
            cand = scoring.candidates(good, similarities_of(spark, sims_path, good), past).checkpoint()
            recs = scoring.scored_recs(good, cand, similarities_of(spark, sims_path, cand), scoring.recent_ratings(past))
            log.append(latest_recs(recs), batch_id)
            seen.append(good, batch_id)
        finally:
            parsed.unpersist()

    src = _source(spark, source, LINE_SCHEMA, max_files, source_format, source_options)
    w = src.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()


def recs_from_log(log: DataFrame) -> DataFrame:
    """StreamRecs as a table: the latest list per user over the whole log."""
    return latest_recs(log.select(*STREAM_RECS.fieldNames()))


def latest_recs(recs: DataFrame) -> DataFrame:
    """Per user, the list of the message with the highest (timestamp, event_id)."""
    last = F.max(F.struct("timestamp", "event_id", "recs")).alias("_l")
    return (recs.groupBy("userId").agg(last)
            .select("userId", "_l.timestamp", "_l.event_id", "_l.recs"))


def run_to_end(q: StreamingQuery) -> None:
    """Wait for an availableNow query and surface its failure."""
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
