"""Connected components of an undirected graph, by alternating stars in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rateflow.llm.common import remove, written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (a, b) with a > b, written.

    The large star links every larger neighbour of a node to the node's smallest
    neighbour; the small star links the node and its smaller neighbours to it.  The
    smallest neighbour is aggregated, written and joined back, so that Spark can split
    the partition of a node with very many neighbours.
    """
    if large:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = written(both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m")))
        linked = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        least = written(edges.groupBy("a").agg(F.min("b").alias("m")))
        linked = edges.join(least, "a").select(
            F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b")).where("a <> b")
    result = written(linked.distinct())
    remove(least, edges)
    return result


def _settled(edges: DataFrame) -> bool:
    """Whether edges (a, b) with a > b are stars: no node has two smaller ones, or a smaller and a larger one.

    Steps keep what is connected, so each star is a whole component then.
    """
    one, none = F.lit(1), F.lit(0)
    ends = edges.select(F.col("a").alias("n"), one.alias("up"), none.alias("down")).union(edges.select("b", none, one))
    return ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 OR up > 0 AND down > 0").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every linked node but the roots; a root is its component's least node.

    Each step is written to the shared folder, and the tables before it are deleted; only
    whether another is needed reaches the driver.
    """
    edges = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                    .where("a <> b").distinct())
    while not _settled(edges):
        edges = _star(_star(edges, large=True), large=False)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
