"""Co-rating counts kept up to date from batches of ratings.

Three keyed logs hold the state: the ratings per user and product, the pair counts and
the ratings per product.  A batch (new ratings, or removed ones with a sign of -1) is
joined with the stored ratings of its own users, read from their buckets, and appends
signed changes; the tables are sums over the logs.  Nothing else is read or rewritten, a
retried batch replaces its own rows, and compaction folds the buckets that changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rateflow.functions.exprs import ITEM_NEIGHBOURS
from rateflow.operators import itemcf
from rateflow.operators.pair_deltas import pair_changes, square_changes
from rateflow.session import shared_dir
from rateflow.sources.tables import BucketedLog

BUCKETS = 64


def _schema(*ints: str, count: str) -> T.StructType:
    return T.StructType([*(T.StructField(c, T.IntegerType()) for c in ints), T.StructField(count, T.LongType())])


class CoRating:
    """Stored co-rating counts under ``path``; batches come with rising numbers."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        shared_dir(spark)
        path = path.rstrip("/")
        self._rated = BucketedLog(spark, f"{path}/ratings", _schema("userId", "productId", count="m"), "userId", buckets)
        self._pairs = BucketedLog(spark, f"{path}/pairs", _schema("product1", "product2", count="cocount"), "product1", buckets)
        self._counts = BucketedLog(spark, f"{path}/counts", _schema("productId", count="count"), "productId", buckets)

    @staticmethod
    def _fold(log: BucketedLog):
        *keys, count = log.schema.fieldNames()

        def fold(rows: DataFrame) -> DataFrame:
            return rows.groupBy(*keys).agg(F.sum(count).alias(count)).where(F.col(count) != 0)
        return fold

    def _total(self, log: BucketedLog, **which) -> DataFrame:
        return self._fold(log)(log.read(**which))

    def add(self, ratings: DataFrame, batch_id: int, sign: str | None = None) -> None:
        """Count a batch; ``sign`` names a column of 1 and -1 for added and removed ratings."""
        weight = F.col(sign).cast("long") if sign else F.lit(1).cast("long")
        changed = (ratings.select("userId", "productId", weight.alias("m")).dropna()
                   .groupBy("userId", "productId").agg(F.sum("m").alias("m")).where(F.col("m") != 0).checkpoint())
        stored = self._total(self._rated, buckets=self._rated.buckets_of(changed), before=batch_id)
        pairs = pair_changes(changed, stored, "userId", "productId", "m", out=("product1", "product2", "cocount"))
        own = square_changes(changed, stored, "userId", "productId", "m", out="cocount").select(
            F.col("productId").alias("product1"), F.col("productId").alias("product2"), "cocount")
        self._pairs.append(pairs.unionByName(own), batch_id)
        self._counts.append(changed.groupBy("productId").agg(F.sum("m").alias("count")), batch_id)
        self._rated.append(changed, batch_id)

    def compact(self, upto: int) -> None:
        for log in (self._rated, self._pairs, self._counts):
            log.compact(self._fold(log), upto)

    def counts(self) -> DataFrame:
        return self._total(self._counts)

    def half_pairs(self) -> DataFrame:
        """(product1 < product2, cocount)."""
        return self._total(self._pairs).where("product1 < product2")

    def cooccurrence(self) -> DataFrame:
        """The table of ``itemcf.cooccurrence``, self pairs included."""
        pairs = self._total(self._pairs)
        own = pairs.where("product1 = product2")
        return itemcf.with_counts(itemcf.both_ways(pairs.where("product1 < product2")).unionByName(own), self.counts())

    def top_neighbours(self, k: int = ITEM_NEIGHBOURS) -> DataFrame:
        """The lists of ``itemcf.top_neighbours``."""
        return itemcf.neighbours_of(itemcf.scored_pairs(self.half_pairs(), self.counts()), k)


def start_co_rating(store: CoRating, ratings: DataFrame, checkpoint: str, trigger: dict | None = None,
                    compact_every: int = 100) -> StreamingQuery:
    """A stream of ratings counted into ``store``, one micro-batch at a time."""
    def step(batch: DataFrame, batch_id: int) -> None:
        if compact_every and batch_id and batch_id % compact_every == 0:
            store.compact(batch_id - 1)
        store.add(batch, batch_id)

    w = ratings.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"processingTime": "2 seconds"})).start()
