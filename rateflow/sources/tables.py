"""Typed table scans and table writes (parquet by default, any format by name)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rateflow.schemas import PRODUCT, RATING
from rateflow.sources import files


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               fmt: str = "parquet") -> DataFrame:
    """Scan a stored table with a fixed schema: no inference, missing columns fail.

    Self-describing formats (parquet, orc) are read with their stored types and
    cast to the declared ones, so an int64 id column still loads as INT; other
    formats get the schema up front.
    """
    r = spark.read.format(fmt)
    if schema is not None and fmt not in ("parquet", "orc"):
        r = r.schema(schema)
    df = r.load(path)
    if schema is not None:
        df = df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
    return df


def read_ratings(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return read_table(spark, path, RATING, fmt)


def read_products(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return read_table(spark, path, PRODUCT, fmt)


def as_ratings(df: DataFrame) -> DataFrame:
    """Project any frame with the rating columns onto the rating schema."""
    return df.select(*[F.col(f.name).cast(f.dataType) for f in RATING.fields])


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by=None) -> None:
    """Replace a derived table (overwrite drops the old content)."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


class KeyedLog:
    """Append-only table written by a stream: micro-batch ``n`` adds its rows
    under ``batch_id=n`` (dynamic partition overwrite, so a retried batch
    replaces exactly its own rows).  A write costs O(batch), never O(table);
    readers fold the log with an aggregate that is combined map-side (latest
    per key, top-k per key), which gives the same answer as an in-place upsert.

    ``compact(fold, upto)`` bounds read cost.  It writes fold(log up to batch
    ``upto``) to a fresh ``_snapshot/<name>`` and then creates an empty file
    ``_marker/<name>``; the name starts with ``upto``.  Nothing is overwritten:
    a stop before the marker leaves readers where they were, and a compaction
    repeated after its marker returns at once.  Readers take the newest marked
    snapshot plus the log batches after it.  Only then are batches and snapshots
    removed that the marker *before* the newest already covers, so a reader that
    has just listed the table still finds its files.  What was removed is noted
    in ``_retired`` first; if the markers are lost after that, reading fails
    rather than returning the tail.  (Spark skips ``_`` folders when listing.)
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self._full = T.StructType(schema.fields + [T.StructField("batch_id", T.LongType())])

    def append(self, df: DataFrame, batch_id: int) -> None:
        (df.select(*self.schema.fieldNames()).withColumn("batch_id", F.lit(batch_id).cast("long"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(self.path))

    def _log(self) -> DataFrame:
        if not any(n.startswith("batch_id=") for n in files.names(self.spark, self.path)):
            return self.spark.createDataFrame([], self._full)
        log = self.spark.read.schema(self._full).parquet(self.path)
        return log.select(*self._full.fieldNames())     # without the buckets of a ``BucketedLog``

    def _snapshots(self) -> list[str]:
        """Folders that make up the newest complete snapshot."""
        names = self._marked()
        folded = self._folded(names)
        return [f"{self.path}/_snapshot/{n}/bucket={b}" for b, n in folded.items()] or [f"{self.path}/_snapshot/{names[-1]}"]

    def _folded(self, names: list[str]) -> dict[int, str]:
        """Per bucket the newest of the snapshots that has it; empty where snapshots have no buckets."""
        found: dict[int, str] = {}
        for name in names:
            found |= {int(n.split("=")[1]): name for n in files.names(self.spark, f"{self.path}/_snapshot/{name}")
                      if n.startswith("bucket=")}
        return found

    def _marked(self) -> list[str]:
        """Names of complete snapshots, oldest first."""
        return sorted(files.names(self.spark, f"{self.path}/_marker"))

    def marker(self) -> int | None:
        """The last batch in the newest complete snapshot."""
        marked = self._marked()
        retired = max(map(int, files.names(self.spark, f"{self.path}/_retired")), default=-1)
        upto = int(marked[-1].split("-")[0]) if marked else -1
        if upto < retired:
            raise RuntimeError(f"{self.path}: batches up to {retired} were folded and removed, "
                               "but no marker of their snapshot is left")
        return upto if marked else None

    def read(self) -> DataFrame:
        m = self.marker()
        log = self._log()
        if m is None:
            return log
        snap = (self.spark.read.schema(self.schema).parquet(*self._snapshots())
                .withColumn("batch_id", F.lit(m).cast("long")))
        return snap.unionByName(log.where(F.col("batch_id") > m))

    def compact(self, fold, upto: int) -> None:
        """``fold``: DataFrame -> DataFrame with this log's columns; must give
        the same result when applied to its own output plus later rows."""
        m = self.marker()
        if m is None or m < upto:
            current = self.read().where(F.col("batch_id") <= upto)
            name = f"{upto:020d}-{uuid.uuid4().hex[:12]}"
            fold(current).select(*self.schema.fieldNames()).write.parquet(f"{self.path}/_snapshot/{name}")
            files.create(self.spark, f"{self.path}/_marker/{name}")
        self._retire()

    def _retire(self) -> None:
        """Remove what the marker before the newest covers."""
        marked = self._marked()
        if len(marked) < 2:
            return
        covered = int(marked[-2].split("-")[0])
        files.create(self.spark, f"{self.path}/_retired/{covered}")
        for n in files.names(self.spark, self.path):
            if n.startswith("batch_id=") and int(n.split("=")[1]) <= covered:
                files.remove(self.spark, f"{self.path}/{n}")
        for n in files.names(self.spark, f"{self.path}/_snapshot"):
            if n < marked[-2]:
                files.remove(self.spark, f"{self.path}/_snapshot/{n}")
        for n in marked[:-2]:
            files.remove(self.spark, f"{self.path}/_marker/{n}")


class BucketedLog(KeyedLog):
    """A keyed log in buckets of its key, each folded on its own.

    Rows lie under ``batch_id=<n>/bucket=<b>``, so a reader of some keys reads their
    buckets' files only.  A compaction rewrites the buckets that have new rows and no
    others: a snapshot holds just those, and of each bucket the newest marked snapshot
    that has it counts.  Markers, retries and retirement work as in ``KeyedLog``.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int):
        super().__init__(spark, path, schema)
        self.key, self.buckets = key, buckets
        self._full = T.StructType([*self._full.fields, T.StructField("bucket", T.IntegerType())])

    def bucket(self, key: str | None = None) -> F.Column:
        """The bucket of a key column."""
        return F.pmod(F.hash(key or self.key), F.lit(self.buckets))

    def buckets_of(self, keys: DataFrame) -> list[int]:
        """Buckets of a table's keys; as many numbers as there are buckets at most."""
        return sorted(r[0] for r in keys.select(self.bucket()).distinct().collect())

    def append(self, df: DataFrame, batch_id: int) -> None:
        (df.select(*self.schema.fieldNames()).withColumn("batch_id", F.lit(batch_id).cast("long"))
         .withColumn("bucket", self.bucket()).repartition("bucket")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id", "bucket").parquet(self.path))

    def read(self, buckets: list[int] | None = None, before: int | None = None) -> DataFrame:
        """Rows of the log; with ``buckets`` only of these, with ``before`` only of earlier batches."""
        m = self.marker()
        log = self._log()
        if buckets is not None:
            log = log.where(F.col("bucket").isin(buckets))
        if before is not None:
            log = log.where(F.col("batch_id") < before)
        if m is None:
            return log.drop("bucket")
        wanted = {b: n for b, n in self._folded(self._marked()).items() if buckets is None or b in buckets}
        log = log.where(F.col("batch_id") > m).drop("bucket")
        if not wanted:
            return log
        # Every compaction marks a snapshot, but one without new rows in any bucket has no folder.
        snap = self.spark.read.schema(self.schema).parquet(*[f"{self.path}/_snapshot/{n}/bucket={b}" for b, n in wanted.items()])
        return snap.withColumn("batch_id", F.lit(m).cast("long")).unionByName(log)

    def compact(self, fold, upto: int) -> None:
        """As ``KeyedLog.compact``, over the buckets with rows since the last marker."""
        m = self.marker()
        if m is None or m < upto:
            since = self._log().where((F.col("batch_id") > (-1 if m is None else m)) & (F.col("batch_id") <= upto))
            touched = sorted(r[0] for r in since.select("bucket").distinct().collect())
            name = f"{upto:020d}-{uuid.uuid4().hex[:12]}"
            if touched:
                current = self.read(touched).where(F.col("batch_id") <= upto)
                (fold(current).select(*self.schema.fieldNames()).withColumn("bucket", self.bucket()).repartition("bucket")
                 .write.partitionBy("bucket").parquet(f"{self.path}/_snapshot/{name}"))
            for b in touched:   # a bucket that folds to nothing must not fall back to an older snapshot
                files.create(self.spark, f"{self.path}/_snapshot/{name}/bucket={b}/_folded")
            files.create(self.spark, f"{self.path}/_marker/{name}")
        self._retire()

    def _retire(self) -> None:
        """Remove what the marker before the newest covers; snapshots that a bucket still needs stay."""
        marked = self._marked()
        if len(marked) < 2:
            return
        covered = int(marked[-2].split("-")[0])
        files.create(self.spark, f"{self.path}/_retired/{covered}")
        for n in files.names(self.spark, self.path):
            if n.startswith("batch_id=") and int(n.split("=")[1]) <= covered:
                files.remove(self.spark, f"{self.path}/{n}")
        held = {n: set(files.names(self.spark, f"{self.path}/_snapshot/{n}")) for n in marked}
        for at, n in enumerate(marked[:-2]):
            later = set().union(*(held[x] for x in marked[at + 1:-1]))
            if {b for b in held[n] if b.startswith("bucket=")} <= later:
                files.remove(self.spark, f"{self.path}/_snapshot/{n}")
                files.remove(self.spark, f"{self.path}/_marker/{n}")
        for n in files.names(self.spark, f"{self.path}/_snapshot"):
            if n < marked[-2] and n not in marked:
                files.remove(self.spark, f"{self.path}/_snapshot/{n}")
