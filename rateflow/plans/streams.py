"""Streaming queries: each writes its input as files, runs the stream to the
end of the available data (availableNow) and returns the result table.  The
stateful streams are run, stopped and run again with newer files, so state is
read back from its log and the checkpoint."""

from __future__ import annotations

from pyspark.sql import functions as F

from rateflow.plans.io_checks import LOG_FILTER_SQL, _ALL_CAST, _RATING_CASTS, msg_parsed
from rateflow.plans.online import (ALL_RECENTS_SQL, LATEST_SQL, ONLINE_VIEWS, SPLIT_EPOCH,
                                   _flat_rounded)
from rateflow.plans.offline import COOCCURRENCE_SQL, COUNTS_SQL, PAIRS_SQL
from rateflow.plans.registry import register
from rateflow.schemas import RATING
from rateflow.session import scratch_path
from rateflow.sources import fixtures as fx
from rateflow.sources import record_log, text
from rateflow.sources.tables import KeyedLog, as_ratings
from rateflow.streaming import jobs, live_state
from rateflow.streaming.co_rating import CoRating

AVAILABLE_NOW = {"availableNow": True}


@register("log_rating_filter_streaming", LOG_FILTER_SQL)
def _log_rating_filter_streaming(spark, d):
    base = scratch_path(spark, "log-stream")
    fx.log_lines(spark, d).write.parquet(f"{base}/source")
    q = jobs.start_log_filter(spark, f"{base}/source", f"{base}/sink", f"{base}/checkpoint",
                              trigger=AVAILABLE_NOW)
    jobs.run_to_end(q)
    return spark.read.parquet(f"{base}/sink").select("event_id", "value")


@register("log_rating_filter_bus", LOG_FILTER_SQL.replace("SELECT event_id, value FROM", "SELECT split_part(value, '|', 1) AS key, value FROM", 1))
def _log_rating_filter_bus(spark, d):
    """Log lines from one record log into another, keyed by user, over two runs."""
    base = scratch_path(spark, "bus")
    record_log.register(spark)
    lines = fx.log_lines(spark, d).select(F.col("event_id").cast("string").alias("key"), "value", (F.col("event_id") % 2).alias("half"))
    for half in (0, 1):
        (lines.where(F.col("half") == half).drop("half").write.format("record_log").option("path", f"{base}/log")
         .option("partitions", 3).mode("append").save())
        q = jobs.start_log_filter(spark, f"{base}/log", f"{base}/ratings", f"{base}/checkpoint", trigger=AVAILABLE_NOW,
                                  source_format="record_log", sink_format="record_log",
                                  sink_options={"writer": "filter", "partitions": 4})
        jobs.run_to_end(q)
    return spark.read.format("record_log").load(f"{base}/ratings").select("key", "value")


@register("rating_message_parse_bus", fx.with_views("rating_message_lines", msg_parsed("rating_message_lines")) + f"""
SELECT event_id, {_RATING_CASTS} FROM parsed WHERE {_ALL_CAST}
""")
def _rating_message_parse_bus(spark, d):
    """Messages read as a stream from a record log of three partitions, stopped and started again half-way."""
    base = scratch_path(spark, "bus")
    record_log.register(spark)
    lines = fx.message_lines(spark, d).select(F.col("event_id").cast("string").alias("key"), "value", (F.col("event_id") % 2).alias("half"))
    for half in (0, 1):
        (lines.where(F.col("half") == half).drop("half").write.format("record_log").option("path", f"{base}/log")
         .option("partitions", 3).mode("append").save())
        records = spark.readStream.format("record_log").load(f"{base}/log")
        parsed = text.parse_rating_messages(records.select(F.col("key").cast("long").alias("event_id"), "value"))
        good, _ = text.split_good_bad(parsed, RATING.fieldNames(), keys=["event_id"])
        jobs.run_to_end(good.writeStream.format("parquet").option("path", f"{base}/good").option("checkpointLocation", f"{base}/checkpoint")
                        .trigger(**AVAILABLE_NOW).start())
    return spark.read.parquet(f"{base}/good")


@register("user_recent_ratings_streaming", fx.with_views("ratings", ALL_RECENTS_SQL) + """
SELECT userId, rank, productId, score FROM recents
""")
def _user_recent_ratings_streaming(spark, d):
    base = scratch_path(spark, "recent-stream")
    rows = as_ratings(fx.ratings(spark, d))
    for newer in (False, True):
        part = rows.where((F.col("timestamp") >= SPLIT_EPOCH) == newer)
        part.write.mode("append").parquet(f"{base}/source")
        q = jobs.start_recent_ratings(spark, f"{base}/source", f"{base}/state", f"{base}/checkpoint",
                                      trigger=AVAILABLE_NOW)
        jobs.run_to_end(q)
    return jobs.recent_from_log(KeyedLog(spark, f"{base}/state", jobs.RECENT_STATE).read())


@register("user_recent_ratings_state", fx.with_views("ratings", ALL_RECENTS_SQL) + """
SELECT userId, rank, productId, score FROM recents
""")
def _user_recent_ratings_state(spark, d):
    """The lists as Spark's keyed state: the newer half of the ratings comes first, then, after a restart,
    the older half late."""
    base = scratch_path(spark, "recent-state")
    rows = as_ratings(fx.ratings(spark, d))
    for newer in (True, False):
        part = rows.where((F.col("timestamp") >= SPLIT_EPOCH) == newer)
        part.repartition(4, F.xxhash64("timestamp", "productId")).write.mode("append").parquet(f"{base}/source")
        lines = spark.readStream.schema(RATING).option("maxFilesPerTrigger", 2).parquet(f"{base}/source")
        jobs.run_to_end(live_state.start_recent_state(spark, lines, f"{base}/checkpoint", trigger=AVAILABLE_NOW))
    return live_state.recent_from_state(spark, f"{base}/checkpoint")


@register("itemcf_cooccurrence_incremental", fx.with_views("ratings", COUNTS_SQL, PAIRS_SQL) + COOCCURRENCE_SQL)
def _itemcf_cooccurrence_incremental(spark, d):
    """Co-rating counts after three batches of ratings, the second of them counted twice by a retry."""
    store = CoRating(spark, scratch_path(spark, "co-rating"), buckets=8)
    rows = fx.ratings(spark, d).withColumn("part", F.pmod(F.xxhash64("userId", "productId", "timestamp"), F.lit(3)))
    for nr, part in enumerate((0, 1, 1, 2)):
        store.add(rows.where(F.col("part") == part), nr - (nr > 1))
        if nr == 2:
            store.compact(1)
    return store.cooccurrence()


# Messages of the first run are history in the second one.
_LIVE = ["""past AS (
  SELECT phase, userId, productId, score, "timestamp" FROM history, (VALUES (0), (1)) AS v(phase)
  UNION ALL SELECT 1, userId, productId, score, "timestamp" FROM gm WHERE phase = 0)""",
         """recents AS (
  SELECT phase, userId, productId, score FROM past
  QUALIFY row_number() OVER (PARTITION BY phase, userId
                             ORDER BY "timestamp" DESC, productId, score DESC) <= 21)""",
         """cand20 AS (
  SELECT m.event_id, m.phase, m.userId, s.simProductId AS productId
  FROM gm m JOIN similarities s ON m.productId = s.productId
  WHERE NOT EXISTS (SELECT 1 FROM past h WHERE h.phase = m.phase AND h.userId = m.userId
                    AND h.productId = s.simProductId)
  QUALIFY row_number() OVER (PARTITION BY m.event_id ORDER BY round(s.sim, 9) DESC, s.simProductId) <= 20)""",
         """scored AS (
  SELECT c.event_id, c.productId,
         avg(s.sim * r.score) + log10(greatest(count_if(r.score > 3), 1))
           - log10(greatest(count_if(r.score <= 3), 1)) AS score
  FROM cand20 c JOIN recents r ON c.userId = r.userId AND c.phase = r.phase
  JOIN similarities s ON s.productId = c.productId AND s.simProductId = r.productId
  WHERE s.sim >= 0.4
  GROUP BY 1, 2)""",
         """ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY event_id
                 ORDER BY round(score, 9) DESC, productId) AS INTEGER) AS rank
  FROM scored)"""]
_GOOD_MESSAGES = f"""gm AS (
  SELECT event_id, {_RATING_CASTS}, CASE WHEN TRY_CAST(f[4] AS INTEGER) >= {SPLIT_EPOCH} THEN 1 ELSE 0 END AS phase
  FROM parsed WHERE {_ALL_CAST})"""


@register("stream_recs_streaming",
          fx.with_views(ONLINE_VIEWS + ["message_lines"], msg_parsed("message_lines"), _GOOD_MESSAGES,
                        *_LIVE, LATEST_SQL.replace("FROM messages", "FROM gm")) + """
SELECT l.userId, r.rank, r.productId, round(r.score, 6) AS score
FROM latest l LEFT JOIN ranked r ON l.event_id = r.event_id
""")
def _stream_recs_streaming(spark, d):
    base = scratch_path(spark, "recs-stream")
    jobs.write_similarities(fx.similarities(spark, d), f"{base}/sims", 16)
    jobs.write_history(as_ratings(fx.history(spark, d)), f"{base}/history")
    msgs = fx.messages(spark, d)
    for newer in (False, True):
        part = msgs.where((F.col("timestamp") >= SPLIT_EPOCH) == newer)
        fx.message_lines(spark, d, part).write.mode("append").parquet(f"{base}/source")
        q = jobs.start_stream_recs(spark, f"{base}/source", f"{base}/StreamRecs", f"{base}/checkpoint",
                                   sims_path=f"{base}/sims", history_path=f"{base}/history",
                                   quarantine_path=f"{base}/quarantine", trigger=AVAILABLE_NOW)
        jobs.run_to_end(q)
    return _flat_rounded(jobs.recs_from_log(jobs.recs_log(spark, f"{base}/StreamRecs").read()), "userId")
