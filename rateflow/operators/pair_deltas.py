"""Changes of co-rating counts, from changed ratings alone.

With m(u, p) the ratings of p by u and d(u, p) their signed change,

    co(p, q) changes by  sum over u of  d(p) m(q) + m(p) d(q) + d(p) d(q)

so a batch meets the stored ratings of its own users only (new x old) and itself (new x
new); no stored pair is built again.  Removed ratings are changes below 0.  As in
``pairs``, a group is split by its sizes: the join is on (group, block of changed rows,
block of all rows), so a user with a large share of all ratings spreads over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rateflow.operators.pairs import BLOCK_ITEMS


def _parts(n: str, block_items: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(F.col(n) / F.lit(block_items))).cast("long")


def pair_changes(changed: DataFrame, stored: DataFrame, group: str, item: str, weight: str,
                 out: tuple[str, str, str] = ("item1", "item2", "change"), block_items: int = BLOCK_ITEMS) -> DataFrame:
    """(item1 < item2, change other than 0) of ``sum over groups of weight * weight``.

    ``changed`` and ``stored`` hold one row (group, item, weight) per group and item; in
    ``changed`` the weight is what is added to the stored one.
    """
    new = changed.where(F.col(weight) != 0).select(group, item, F.col(weight).alias("_d"))
    zero = F.lit(0).cast(changed.schema[weight].dataType)
    old = stored.join(new.select(group).distinct(), group, "left_semi").select(group, item, F.col(weight).alias("_m"), zero.alias("_d"))
    whole = (old.unionByName(new.select(group, item, zero.alias("_m"), "_d"))
             .groupBy(group, item).agg(F.sum("_m").alias("_m"), F.sum("_d").alias("_d")))
    sizes = whole.groupBy(group).agg(F.count(F.lit(1)).alias("_n"), F.count_if(F.col("_d") != 0).alias("_c")).select(
        group, _parts("_c", block_items).alias("_s1"), _parts("_n", block_items).alias("_s2"))
    rows = whole.join(sizes, group)
    a = rows.where(F.col("_d") != 0).select(
        group, F.col(item).alias("_p"), F.col("_d").alias("_dp"), F.pmod(F.xxhash64(item), F.col("_s1")).alias("_b1"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("_s2") - 1)).alias("_b2"))
    b = rows.select(group, F.col(item).alias("_q"), F.col("_m").alias("_mq"), F.col("_d").alias("_dq"),
                    F.pmod(F.xxhash64(F.lit(1), item), F.col("_s2")).alias("_b2"),
                    F.explode(F.sequence(F.lit(0).cast("long"), F.col("_s1") - 1)).alias("_b1"))
    # Two changed rows of a group meet twice, in either order: their product counts once.
    both = F.when(F.col("_p") < F.col("_q"), F.col("_dp") * F.col("_dq")).otherwise(zero)
    met = a.join(b, [group, "_b1", "_b2"]).where(F.col("_p") != F.col("_q"))
    return (met.groupBy(F.least("_p", "_q").alias(out[0]), F.greatest("_p", "_q").alias(out[1]))
            .agg(F.sum(F.col("_dp") * F.col("_mq") + both).alias(out[2])).where(F.col(out[2]) != 0))


def square_changes(changed: DataFrame, stored: DataFrame, group: str, item: str, weight: str, out: str = "change") -> DataFrame:
    """(item, change other than 0) of ``sum over groups of weight ** 2``: the pairs of an item with itself."""
    old = stored.select(group, item, F.col(weight).alias("_m"))
    rows = changed.select(group, item, F.col(weight).alias("_d")).join(old, [group, item], "left")
    square = F.col("_d") * (2 * F.coalesce("_m", F.lit(0)) + F.col("_d"))
    return rows.groupBy(item).agg(F.sum(square).alias(out)).where(F.col(out) != 0)
