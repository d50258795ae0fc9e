"""Rescoring of similar products for incoming ratings, as set operations.

For a message e = (user u, product p):

    C(e) = 20 products q most similar to p that u has not rated
    R(u) = u's 21 most recent ratings (r, score)
    for c in C(e), over r in R(u) with sim(c, r) >= 0.4:
        level(c) = avg(sim * score) + log10(max(#score > 3, 1)) - log10(max(#score <= 3, 1))

Each step is a join or a grouped aggregate over all messages of a batch at
once: candidates are a join of messages with the similarity table minus an
anti-join on what the user rated, the candidate x recent-rating loop is an
equi-join on the user, the lookup is a join on the product pair.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateflow.functions.exprs import (CANDIDATES, LIKE_ABOVE, MIN_SCORING_SIM, RECENT_RATINGS,
                                      rank_key, recommendation_level)
from rateflow.operators.topk import empty_recs, nest, rank_within, top_k_per_group


def recent_ratings(history: DataFrame, k: int = RECENT_RATINGS) -> DataFrame:
    """(userId, rank, productId, score): newest k ratings per user.
    Order: timestamp desc, then productId asc, then score desc."""
    h = history.select("userId", "productId", "score", "timestamp")
    t = top_k_per_group(h, ["userId"], [F.col("timestamp").desc(), F.col("productId").asc(),
                                        F.col("score").desc()], k)
    return t.select("userId", "rank", "productId", "score")


def candidates(messages: DataFrame, sims: DataFrame, rated: DataFrame,
               k: int = CANDIDATES) -> DataFrame:
    """(event_id, userId, rank, productId, sim): k most similar unrated products.

    A message whose product has no similarity row yields no candidates.
    """
    m = messages.select("event_id", "userId", "productId")
    c = (m.join(sims, "productId")
         .select("event_id", "userId", F.col("simProductId").alias("productId"), "sim"))
    seen = rated.select("userId", "productId")
    c = c.join(seen, ["userId", "productId"], "left_anti")
    t = top_k_per_group(c, ["event_id", "userId"], [rank_key("sim").desc(), F.col("productId").asc()], k)
    return t.select("event_id", "userId", "rank", "productId", "sim")


def pair_similarity_lookup(messages: DataFrame, recents: DataFrame,
                           sims: DataFrame) -> DataFrame:
    """(event_id, productId, recentProductId, sim): similarity of the message's
    product to each recent rating of its user, 0.0 when the pair is unknown."""
    m = messages.select("event_id", "userId", "productId")
    r = recents.select("userId", F.col("productId").alias("recentProductId"))
    s = sims.select("productId", F.col("simProductId").alias("recentProductId"), "sim")
    return (m.join(r, "userId").join(s, ["productId", "recentProductId"], "left")
            .select("event_id", "productId", "recentProductId",
                    F.coalesce("sim", F.lit(0.0)).alias("sim")))


def scores(cands: DataFrame, recents: DataFrame, sims: DataFrame,
           min_sim: float = MIN_SCORING_SIM) -> DataFrame:
    """(event_id, userId, productId, score) for candidates with a qualifying
    neighbour among the user's recent ratings."""
    c = cands.select("event_id", "userId", "productId")
    r = recents.select("userId", F.col("productId").alias("recentProductId"),
                       F.col("score").alias("recentScore"))
    s = sims.where(F.col("sim") >= min_sim).select(
        "productId", F.col("simProductId").alias("recentProductId"), "sim")
    j = c.join(r, "userId").join(s, ["productId", "recentProductId"])
    agg = j.groupBy("event_id", "userId", "productId").agg(
        F.avg(F.col("sim") * F.col("recentScore")).alias("_mean"),
        F.count_if(F.col("recentScore") > LIKE_ABOVE).alias("_likes"),
        F.count_if(F.col("recentScore") <= LIKE_ABOVE).alias("_dislikes"))
    return agg.select("event_id", "userId", "productId",
                      recommendation_level("_mean", "_likes", "_dislikes").alias("score"))


def ranked_scores(sc: DataFrame) -> DataFrame:
    """Adds ``rank`` per message: score desc, then product id."""
    return rank_within(sc, ["event_id", "userId"], [rank_key("score").desc(), F.col("productId")])


def message_recs(messages: DataFrame, sims: DataFrame, rated: DataFrame,
                 recents: DataFrame) -> DataFrame:
    """(event_id, userId, timestamp, recs) per message; recs is sorted best
    first and empty when nothing scored."""
    return scored_recs(messages, candidates(messages, sims, rated), sims, recents)


def scored_recs(messages: DataFrame, cand: DataFrame, sims: DataFrame, recents: DataFrame) -> DataFrame:
    """``message_recs`` from the messages' candidates; ``sims`` needs the candidates' rows only."""
    ranked = ranked_scores(scores(cand, recents, sims))
    nested = nest(ranked.select("event_id", "userId", "rank", "productId", "score"), ["event_id", "userId"],
                  items=(("productId", "productId"), ("score", "score")))
    m = messages.select("event_id", "userId", "timestamp")
    return (m.join(nested, ["event_id", "userId"], "left")
            .select("event_id", "userId", "timestamp",
                    F.coalesce("recs", empty_recs()).alias("recs")))


def latest_per_user(recs: DataFrame) -> DataFrame:
    """One list per user: the one of the latest message (timestamp, event_id).
    An aggregate, so it is combined map-side even for a very active user."""
    last = F.max(F.struct("timestamp", "event_id", "recs")).alias("_l")
    return recs.groupBy("userId").agg(last).select("userId", F.col("_l.recs").alias("recs"))


def flat_recs(nested: DataFrame, key: str) -> DataFrame:
    """(key, rank, productId, score); an empty list gives one row of NULLs."""
    e = nested.select(key, F.posexplode_outer("recs").alias("_pos", "_rec"))
    return e.select(key, (F.col("_pos") + 1).alias("rank"),
                    F.col("_rec.productId").alias("productId"),
                    F.col("_rec.score").alias("score"))
