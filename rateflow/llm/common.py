"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from rateflow.session import scratch_path, shared_dir
from rateflow.sources import files

# Words are runs of anything but ASCII white space (the blank and \t \n \v \f \r).
WORD = r"[^\x20\x09-\x0D]+"
find_words = re.compile(WORD).findall

# Rows of one Arrow batch: texts can be long, so batches hold few of them.
ARROW_ROWS = 1000


_P, _Q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
BLANK = np.uint64(32)


def code_points(text: str | None) -> np.ndarray:
    """A text's code points between two blanks, with every run of white space as one blank."""
    a = np.frombuffer(f" {text or ''} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    white = (a == 32) | ((a >= 9) & (a <= 13))
    a = np.where(white, BLANK, a.astype(np.uint64))
    return a[~(white & np.concatenate(([False], white[:-1])))]


def word_codes(points: np.ndarray) -> np.ndarray:
    """A 64-bit hash per word of ``code_points``: a polynomial in its code points, mixed."""
    ends = np.flatnonzero(points == BLANK)
    if len(ends) < 2:
        return np.zeros(0, np.uint64)
    lengths = np.diff(ends)
    place = np.arange(1, len(points)) - np.repeat(ends[:-1] + 1, lengths)
    powers = np.multiply.accumulate(np.full(int(lengths.max()) + 1, _P))
    h = np.add.reduceat(points[1:] * powers[place], ends[:-1])
    h = (h ^ (h >> np.uint64(29))) * _Q
    return h ^ (h >> np.uint64(32))


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """The named columns of a given table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*cols)


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small, as rows carry whole texts of any length."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def append_columns(df: DataFrame, fields: list[T.StructField], start) -> DataFrame:
    """All columns of ``df`` followed by computed ones, without a shuffle.

    ``start()`` runs once per task and returns a function from an Arrow record
    batch to the list of the new columns' arrays.
    """
    small_batches(df.sparkSession)
    schema = T.StructType([*df.schema.fields, *fields])
    new_types = [(f.name, f.dataType) for f in fields]

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type
        step = start()
        for batch in batches:
            new = [pa.array(v, type=to_arrow_type(t)) if not isinstance(v, pa.Array) else v
                   for v, (_, t) in zip(step(batch), new_types)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new],
                                             names=[*batch.schema.names, *(n for n, _ in new_types)])

    return df.mapInArrow(run, schema)


def settled(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read from there.

    Cuts the lineage, so a lost executor repeats no earlier work, and lets several
    readers share one computation.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table of its own in the shared folder, read from there.

    As ``settled``, for chains of many joins: a checkpoint hands on its plan's size estimate,
    the product of what was joined, and over many rounds that number alone fills the
    driver's memory.  A table's size is known from its files.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(*tables: DataFrame) -> None:
    """Delete tables of ``written`` that nothing reads any more."""
    for df in tables:
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            files.remove(df.sparkSession, folder)


def word_count(text: Column) -> Column:
    """Number of words of a text; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def bucket_of(n: Column | int, *cols: Column) -> Column:
    """A bucket from 0 to n - 1, the same on every run, spread evenly over rows."""
    n = n if isinstance(n, Column) else F.lit(n)
    return F.pmod(F.xxhash64(*cols), F.greatest(n, F.lit(1)).cast("long"))
