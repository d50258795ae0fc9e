"""Per-group top-k and the nested <-> flat forms of recommendation lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k_per_group(df: DataFrame, group_cols, order_cols, k: int,
                    rank_col: str = "rank") -> DataFrame:
    """Rows with ``row_number() <= k`` per group.

    The ``row_number`` + filter shape lets Catalyst insert a partial
    WindowGroupLimit before the shuffle, so a hot group sends at most k rows
    per input partition instead of all of its rows.
    """
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def rank_within(df: DataFrame, group_cols, order_cols, rank_col: str = "rank") -> DataFrame:
    """``row_number()`` per group without a cap (whole ranked list)."""
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    return df.withColumn(rank_col, F.row_number().over(w))


def nest(df: DataFrame, key: str | list[str], rank_col: str = "rank",
         items=(("simProductId", "productId"), ("score", "score")),
         out_col: str = "recs") -> DataFrame:
    """Flat ranked rows -> one row per key with an ordered array of structs.

    Meant for lists already capped by a top-k, so each collected list is small.
    """
    fields = [F.col(src).alias(dst) for src, dst in items]
    packed = F.sort_array(F.collect_list(F.struct(F.col(rank_col).alias("_r"), *fields)))
    names = [dst for _, dst in items]
    strip = F.transform(F.col("_l"), lambda s: F.struct(*[s[n].alias(n) for n in names]))
    keys = [key] if isinstance(key, str) else key
    return df.groupBy(*keys).agg(packed.alias("_l")).select(*keys, strip.alias(out_col))


def empty_recs() -> Column:
    return F.array().cast("array<struct<productId:int,score:double>>")


def flatten(nested: DataFrame, key: str, recs_col: str = "recs",
            out=("simProductId", "score")) -> DataFrame:
    """Nested list -> (key, neighbour, score); a neighbour listed twice keeps the
    later entry, as a map built from the list would."""
    pos = nested.select(key, F.posexplode(recs_col).alias("_pos", "_rec"))
    last = F.max_by(F.col("_rec.score"), F.col("_pos"))
    return (pos.groupBy(key, F.col("_rec.productId").alias(out[0]))
            .agg(last.alias(out[1])))
