"""Online rescoring queries (batch form of the streaming job)."""

from __future__ import annotations

import calendar
import time

from pyspark.sql import functions as F

from rateflow.functions.exprs import round6
from rateflow.operators import scoring
from rateflow.plans.registry import register
from rateflow.session import scratch_path
from rateflow.sources import fixtures as fx
from rateflow.sources.tables import KeyedLog
from rateflow.streaming.jobs import STREAM_RECS, latest_recs, recs_from_log

# All stored and incoming ratings count for the list of recent ratings itself.
ALL_RECENTS_SQL = """recents AS (
  SELECT userId, CAST(row_number() OVER (PARTITION BY userId
                  ORDER BY "timestamp" DESC, productId ASC, score DESC) AS INTEGER) AS rank,
         productId, score
  FROM ratings QUALIFY rank <= 21)"""
RECENTS_SQL = """recents AS (
  SELECT userId, CAST(row_number() OVER (PARTITION BY userId
                  ORDER BY "timestamp" DESC, productId ASC, score DESC) AS INTEGER) AS rank,
         productId, score
  FROM history QUALIFY rank <= 21)"""
CAND_SQL = """cand AS (
  SELECT m.event_id, m.userId, s.simProductId AS productId, s.sim
  FROM messages m JOIN similarities s ON m.productId = s.productId
  WHERE NOT EXISTS (SELECT 1 FROM history h
                    WHERE h.userId = m.userId AND h.productId = s.simProductId)),
cand20 AS (
  SELECT event_id, userId,
         CAST(row_number() OVER (PARTITION BY event_id
              ORDER BY round(sim, 9) DESC, productId) AS INTEGER) AS rank,
         productId, sim
  FROM cand QUALIFY rank <= 20)"""
SCORED_SQL = """scored AS (
  SELECT c.event_id, c.userId, c.productId,
         avg(s.sim * r.score) + log10(greatest(count_if(r.score > 3), 1))
           - log10(greatest(count_if(r.score <= 3), 1)) AS score
  FROM cand20 c JOIN recents r ON c.userId = r.userId
  JOIN similarities s ON s.productId = c.productId AND s.simProductId = r.productId
  WHERE s.sim >= 0.4
  GROUP BY 1, 2, 3),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY event_id
                 ORDER BY round(score, 9) DESC, productId) AS INTEGER) AS rank
  FROM scored)"""
ONLINE_VIEWS = ["ratings", "history", "messages", "similarities"]


def _inputs(spark, d, messages=None):
    hist = fx.history(spark, d)
    sims = fx.similarities(spark, d)
    msgs = fx.messages(spark, d) if messages is None else messages
    return msgs, hist, sims, scoring.recent_ratings(hist)


register("user_recent_ratings", fx.with_views("ratings", ALL_RECENTS_SQL) + """
SELECT userId, rank, productId, score FROM recents
""")(lambda spark, d: scoring.recent_ratings(fx.ratings(spark, d)))


@register("candidate_products", fx.with_views(ONLINE_VIEWS, CAND_SQL) + """
SELECT event_id, userId, rank, productId, round(sim, 6) AS sim FROM cand20
""")
def _candidate_products(spark, d):
    msgs, hist, sims, _ = _inputs(spark, d)
    c = scoring.candidates(msgs, sims, hist)
    return c.select("event_id", "userId", "rank", "productId", round6("sim").alias("sim"))


@register("pair_similarity_lookup", fx.with_views(ONLINE_VIEWS, RECENTS_SQL) + """
SELECT m.event_id, m.productId, r.productId AS recentProductId,
       round(coalesce(s.sim, 0.0), 6) AS sim
FROM messages m JOIN recents r ON m.userId = r.userId
LEFT JOIN similarities s ON s.productId = m.productId AND s.simProductId = r.productId
""")
def _pair_similarity_lookup(spark, d):
    msgs, _, sims, recents = _inputs(spark, d)
    p = scoring.pair_similarity_lookup(msgs, recents, sims)
    return p.select("event_id", "productId", "recentProductId", round6("sim").alias("sim"))


@register("stream_scores", fx.with_views(ONLINE_VIEWS, RECENTS_SQL, CAND_SQL, SCORED_SQL) + """
SELECT event_id, userId, productId, round(score, 6) AS score FROM scored
""")
def _stream_scores(spark, d):
    msgs, hist, sims, recents = _inputs(spark, d)
    s = scoring.scores(scoring.candidates(msgs, sims, hist), recents, sims)
    return s.select("event_id", "userId", "productId", round6("score").alias("score"))


def _flat_rounded(df, key):
    f = scoring.flat_recs(df, key)
    return f.select(key, "rank", "productId", round6("score").alias("score"))


@register("stream_recs", fx.with_views(ONLINE_VIEWS, RECENTS_SQL, CAND_SQL, SCORED_SQL) + """
SELECT m.event_id, r.rank, r.productId, round(r.score, 6) AS score
FROM messages m LEFT JOIN ranked r ON m.event_id = r.event_id
""")
def _stream_recs(spark, d):
    msgs, hist, sims, recents = _inputs(spark, d)
    return _flat_rounded(scoring.message_recs(msgs, sims, hist, recents), "event_id")


SPLIT_EPOCH = calendar.timegm(time.strptime(fx.STREAM_SPLIT_TS, "%Y-%m-%d %H:%M:%S"))

LATEST_SQL = """latest AS (
  SELECT event_id, userId FROM messages
  QUALIFY row_number() OVER (PARTITION BY userId ORDER BY "timestamp" DESC, event_id DESC) = 1)"""


@register("stream_recs_upsert",
          fx.with_views(ONLINE_VIEWS, RECENTS_SQL, CAND_SQL, SCORED_SQL, LATEST_SQL) + """
SELECT l.userId, r.rank, r.productId, round(r.score, 6) AS score
FROM latest l LEFT JOIN ranked r ON l.event_id = r.event_id
""")
def _stream_recs_upsert(spark, d):
    """Two micro-batches of messages (before / after a fixed time) upserted in
    turn into the StreamRecs log; the last list per user wins."""
    msgs, hist, sims, recents = _inputs(spark, d)
    msgs = msgs.withColumn("event_id", F.lpad(F.col("event_id").cast("string"), 20, "0"))
    log = KeyedLog(spark, scratch_path(spark, "StreamRecs"), STREAM_RECS)
    sims = sims.checkpoint()          # used by both batches, twice each
    for batch, part in enumerate([msgs.where(F.col("timestamp") < SPLIT_EPOCH),
                                  msgs.where(F.col("timestamp") >= SPLIT_EPOCH)]):
        log.append(latest_recs(scoring.message_recs(part, sims, hist, recents)), batch)
    return _flat_rounded(recs_from_log(log.read()), "userId")
