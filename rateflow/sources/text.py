"""Delimited-text sources: product file, rating file, rating messages, log lines.

Every parser takes a DataFrame with a string column ``value`` (what
``spark.read.text`` and ``readStream.text`` give), so batch files, streams and
derived test lines all go through the same JVM-side expressions.  Rows that
are too short or do not cast are not fatal: ``split_good_bad`` puts them in a
quarantine frame with a reason.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rateflow.functions.exprs import field, jvm_trim, split_fields, text_after_prefix
from rateflow.schemas import PRODUCT, RATING

REASON = "_reason"


def _reason(n_fields, need: int, casts) -> F.Column:
    bad_cast = None
    for c in casts:
        bad_cast = c.isNull() if bad_cast is None else (bad_cast | c.isNull())
    return (F.when(n_fields < need, F.lit("short_row"))
            .when(bad_cast, F.lit("bad_value")))


def parse_product_lines(lines: DataFrame) -> DataFrame:
    """'^'-separated: id ^ name ^ category ids ^ code ^ imageUrl ^ categories ^ tags.

    Fields 2 and 3 are dropped, strings are trimmed, extra fields ignored.
    """
    f = split_fields("value", "\\^")
    pid = field(f, 0).try_cast("int")
    keep = [c for c in lines.columns if c != "value"]
    return lines.select(
        *keep, "value",
        pid.alias("productId"),
        jvm_trim(field(f, 1)).alias("name"),
        jvm_trim(field(f, 4)).alias("imageUrl"),
        jvm_trim(field(f, 5)).alias("categories"),
        jvm_trim(field(f, 6)).alias("tags"),
        _reason(F.size(f), 7, [pid]).alias(REASON),
    )


def _parse_rating_fields(lines: DataFrame, delim_regex: str) -> DataFrame:
    f = split_fields("value", delim_regex)
    u = field(f, 0).try_cast("int")
    p = field(f, 1).try_cast("int")
    s = field(f, 2).try_cast("double")
    t = field(f, 3).try_cast("int")
    keep = [c for c in lines.columns if c != "value"]
    return lines.select(
        *keep, "value",
        u.alias("userId"), p.alias("productId"), s.alias("score"), t.alias("timestamp"),
        _reason(F.size(f), 4, [u, p, s, t]).alias(REASON),
    )


def parse_rating_lines(lines: DataFrame) -> DataFrame:
    """Comma text: userId,productId,score,timestamp (epoch seconds)."""
    return _parse_rating_fields(lines, ",")


def parse_rating_messages(lines: DataFrame) -> DataFrame:
    """Bus messages: userId|productId|score|timestamp."""
    return _parse_rating_fields(lines, "\\|")


def split_good_bad(parsed: DataFrame, columns, keys=()) -> tuple[DataFrame, DataFrame]:
    """(good rows with ``columns``, quarantined rows: ``keys``, value, reason)."""
    good = parsed.where(F.col(REASON).isNull()).select(*keys, *columns)
    bad = parsed.where(F.col(REASON).isNotNull()).select(
        *keys, "value", F.col(REASON).alias("reason"))
    return good, bad


def extract_rating_payloads(log: DataFrame) -> DataFrame:
    """Keep log lines carrying the rating prefix; forward the trimmed text after it."""
    keep = [c for c in log.columns if c != "value"]
    payload = text_after_prefix("value")
    return log.select(*keep, payload.alias("value")).where(F.col("value").isNotNull())


# -- file readers -----------------------------------------------------------

def read_products_text(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    parsed = parse_product_lines(spark.read.text(path))
    return split_good_bad(parsed, PRODUCT.fieldNames())


def read_ratings_text(spark: SparkSession, path: str, quoted: bool = False,
                      multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """Ratings and the quarantine of a comma file; with ``quoted`` by the CSV reader, which knows quotes."""
    parsed = parse_ratings_csv(spark, path, multi_line=multi_line) if quoted else parse_rating_lines(spark.read.text(path))
    return split_good_bad(parsed, RATING.fieldNames())


_CSV = "f0 string, f1 string, f2 string, f3 string, more string, raw string"


def parse_ratings_csv(spark: SparkSession, path: str, delimiter: str = ",", multi_line: bool = False) -> DataFrame:
    """The frame of ``parse_rating_lines``, read by Spark's CSV source.

    Fields may be quoted and then hold delimiters and doubled quotes; with ``multi_line`` line
    ends too, at the price that one task reads a whole file.  The schema is bound (one column more than a rating has, as further fields are ignored) and
    the mode permissive: a row with any other number of fields keeps what it has, and its
    record as written in ``value``.  Of a row with exactly as many fields as the
    schema, the record is put together again.
    """
    rows = (spark.read.schema(_CSV).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "raw")
            .option("sep", delimiter).option("multiLine", multi_line).option("quote", '"').option("escape", '"')
            .csv(path))
    fields = ["f0", "f1", "f2", "f3"]
    u, p, t = (F.col(c).try_cast("int") for c in ("f0", "f1", "f3"))
    s = F.col("f2").try_cast("double")
    written = F.coalesce("raw", F.concat_ws(delimiter, *[F.coalesce(c, F.lit("")) for c in (*fields, "more")]))
    # Of a longer record fields beyond the schema are seen in ``raw`` only, where quoted ones may hold delimiters.
    as_written = F.size(split_fields(F.regexp_replace("raw", '"[^"]*"', "q"), re.escape(delimiter)))
    short = F.col("f3").isNull() & F.col("more").isNull() & (F.col("raw").isNull() | (as_written < 4))
    return rows.select(written.alias("value"), u.alias("userId"), p.alias("productId"), s.alias("score"), t.alias("timestamp"),
                       _reason(F.when(short, F.lit(3)).otherwise(F.lit(4)), 4, [u, p, s, t]).alias(REASON))
