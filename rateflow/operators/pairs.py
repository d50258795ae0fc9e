"""Sum of weight products over item pairs that share a group, with hot groups split.

    pair_sums(g, i, w) = { (a < b): sum over groups g holding both a and b of w(g,a) * w(g,b) }

Used for co-rating counts (group = user, weight = multiplicity) and for partial
dot products of sparse vectors (group = term, weight = term weight).

The self-join is on (group, b1, b2) with b = hash(item) mod s(group), where
s(group) grows with the group's size: a group holding a large share of all
rows is split into s*(s+1)/2 join keys of bounded size spread over many
tasks, while ordinary groups (s = 1) are neither replicated nor split.  The
products are summed with partial aggregation in the join stage, so only
per-task pair sums are shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Items per block of a split group.
BLOCK_ITEMS = 1024


def pair_sums(df: DataFrame, group: str, item: str, weight: str,
              out: tuple[str, str, str] = ("item1", "item2", "total"),
              block_items: int = BLOCK_ITEMS) -> DataFrame:
    """(item1 < item2, total); ``df`` must hold one row per (group, item)."""
    size = df.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    split = F.greatest(F.lit(1), F.ceil(F.col("_n") / F.lit(block_items)))
    rows = (df.select(group, item, weight)
            .join(size.select(group, split.cast("int").alias("_s")), group)
            .withColumn("_blk", F.pmod(F.xxhash64(item), F.col("_s")).cast("int")))
    left = rows.select(group, F.col(item).alias("_ia"), F.col(weight).alias("_wa"),
                       F.col("_blk").alias("_b1"),
                       F.explode(F.sequence(F.col("_blk"), F.col("_s") - 1)).alias("_b2"))
    right = rows.select(group, F.col(item).alias("_ib"), F.col(weight).alias("_wb"),
                        F.explode(F.sequence(F.lit(0), F.col("_blk"))).alias("_b1"),
                        F.col("_blk").alias("_b2"))
    # Blocks b1 < b2 pair every item of b1 with every item of b2 (ids are
    # distinct across blocks); inside one block only ia < ib is kept.
    j = (left.join(right, [group, "_b1", "_b2"])
         .where((F.col("_b1") < F.col("_b2")) | (F.col("_ia") < F.col("_ib"))))
    return (j.groupBy(F.least("_ia", "_ib").alias(out[0]), F.greatest("_ia", "_ib").alias(out[1]))
            .agg(F.sum(F.col("_wa") * F.col("_wb")).alias(out[2])))


def mirror(half: DataFrame, a: str, b: str, rest=()) -> DataFrame:
    """(a, b, rest) -> both (a, b, rest) and (b, a, rest) in one pass over ``half``
    (an explode, so the subtree that built ``half`` is not planned twice)."""
    both = F.explode(F.array(F.struct(F.col(a).alias("_x"), F.col(b).alias("_y")),
                             F.struct(F.col(b).alias("_x"), F.col(a).alias("_y"))))
    return (half.select(both.alias("_p"), *rest)
            .select(F.col("_p._x").alias(a), F.col("_p._y").alias(b), *rest))
