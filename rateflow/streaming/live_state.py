"""Recent ratings per user as Spark's own keyed state.

The newest ratings of a user are a list state of a ``transformWithState`` operator, held by
RocksDB on the executors and saved with the stream's checkpoint: a micro-batch touches
the lists of its users only, a restart resumes them, and a list unused for the time to
live goes away.  Before the shuffle every few Arrow batches are cut to each user's newest rows, so a
user with a third of a batch sends a few lists, not all ratings.

``recent_from_state`` reads the lists of a stopped or running stream by key from its
checkpoint, as a table.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from rateflow.functions.exprs import RECENT_RATINGS
from rateflow.operators.topk import top_k_per_group
from rateflow.schemas import RATING
from rateflow.sources import text

CUT_ROWS = 10000    # rows of a task that are cut together, at least
STATE = "recent"
STATE_SCHEMA = "productId int, score double, timestamp int"
LISTS = "userId int, recents array<struct<productId:int,score:double,timestamp:int>>"
# Options that a stream with this state needs at its start.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def _newest_first(r: tuple) -> tuple:
    """Sort key of (productId, score, timestamp): newest, then smaller product, then higher score."""
    return -r[2], r[0], -r[1]


class RecentRatings(StatefulProcessor):
    """Keeps the newest ``k`` ratings per user and emits each list that a batch changed."""

    def __init__(self, k: int = RECENT_RATINGS, ttl_ms: int | None = None):
        self.k, self.ttl_ms = k, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.recent = handle.getListState(STATE, STATE_SCHEMA, self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        before = [tuple(r) for r in self.recent.get()] if self.recent.exists() else []
        new = ((r.productId, r.score, r.timestamp) for r in rows)
        # A heap of k rows, however many the user sent.
        now = heapq.nsmallest(self.k, (r for part in (before, new) for r in part), key=_newest_first)
        if sorted(now) != sorted(before):
            self.recent.put(now)
            yield Row(userId=key[0], recents=[Row(productId=p, score=s, timestamp=t) for p, s, t in now])

    def close(self) -> None:
        pass


def newest_of_batches(ratings: DataFrame, k: int = RECENT_RATINGS) -> DataFrame:
    """Every ``CUT_ROWS`` rows of a task, or a few more, cut to the newest ``k`` per user: only these can get into a list."""
    names = RATING.fieldNames()

    def cut(kept):
        rows = pd.concat(kept)
        order = rows.sort_values(["timestamp", "productId", "score"], ascending=[False, True, False], kind="stable")
        return order.groupby("userId", sort=False).head(k)[names]

    def run(batches):
        # Other operators of a session may have set small Arrow batches.
        kept, size = [], 0
        for rows in batches:
            kept.append(rows)
            size += len(rows)
            if size >= CUT_ROWS:
                yield cut(kept)
                kept, size = [], 0
        if size:
            yield cut(kept)

    return ratings.select(*names).mapInPandas(run, RATING)


def start_recent_state(spark: SparkSession, lines: DataFrame, checkpoint: str, k: int = RECENT_RATINGS,
                       ttl_ms: int | None = None, trigger: dict | None = None, on_change=None) -> StreamingQuery:
    """A stream of ratings, or of message lines (a ``value`` column), -> the newest ``k`` per user as state.

    ``on_change(lists, batch_id)`` gets the changed lists of every batch.  Rows with a null or
    unreadable field are left out.  A time to live needs a trigger that goes on: under
    ``availableNow`` Spark plans batches without data for it and does not come to an end.
    """
    if ttl_ms and trigger and trigger.get("availableNow"):
        raise ValueError("a time to live does not go with availableNow")
    if "value" in lines.columns:
        lines, _ = text.split_good_bad(text.parse_rating_messages(lines), RATING.fieldNames())
    rows = newest_of_batches(lines.select(*RATING.fieldNames()).dropna(), k)
    lists = rows.groupBy("userId").transformWithState(
        RecentRatings(k, ttl_ms), LISTS, "Update", "processingTime" if ttl_ms else "none")
    w = lists.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    w = w.foreachBatch(on_change) if on_change else w.format("noop")
    before = {name: spark.conf.get(name, None) for name in STATE_CONF}
    for name, value in STATE_CONF.items():
        spark.conf.set(name, value)
    try:
        return w.trigger(**(trigger or {"processingTime": "2 seconds"})).start()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


def recent_from_state(spark: SparkSession, checkpoint: str, k: int = RECENT_RATINGS, users: DataFrame | None = None) -> DataFrame:
    """(userId, rank, productId, score) of the lists in a stream's state; ``users`` (userId) limits them."""
    state = (spark.read.format("statestore").option("stateVarName", STATE).option("flattenCollectionTypes", "true").load(checkpoint)
             .select(F.col("key.userId").alias("userId"), "list_element.*"))
    if users is not None:
        state = state.join(users.select("userId").distinct(), "userId", "left_semi")
    order = [F.col("timestamp").desc(), F.col("productId").asc(), F.col("score").desc()]
    return top_k_per_group(state, ["userId"], order, k).select("userId", "rank", "productId", "score")
