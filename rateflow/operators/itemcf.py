"""Item similarity from co-rating (item-based collaborative filtering).

    n(p)      = ratings of product p
    co(p, q)  = sum over users of m(u,p) * m(u,q), m = ratings of p by u
    sim(p, q) = co / sqrt(n(p) * n(q))

Duplicate ratings count with their multiplicity, as a plain self-join on the
user would count them (so a similarity can exceed 1).

Plan shape, chosen for very large inputs:

* ratings are first collapsed to (user, product, m) -- a map-side combined
  aggregate -- so duplicates never multiply rows in the pair join;
* only half of the pairs (p < q) are built and later mirrored;
* the pair join splits a user who rated a large share of the catalogue into
  bounded sub-joins (``pairs.pair_sums``), and pair counts are summed with
  partial aggregation in the join stage;
* per-product counts are joined after aggregation (small side, AQE broadcast);
* of a user who rated thousands of products, the top-k lists build no pairs at all: what
  such a user adds to a pair depends on the two products' multiplicities and counts only,
  so products equal in these are compared as one (``top_neighbours``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateflow.functions.exprs import ITEM_NEIGHBOURS, cooccurrence_sim, rank_key
from rateflow.operators.pairs import mirror, pair_sums
from rateflow.operators.topk import empty_recs, nest, top_k_per_group
from rateflow.session import shared_dir

HOT_ITEMS = 4096    # products of a user whose pairs the top-k lists do not build
HOT_USERS = 16      # such users at most, the largest; the pairs of others are built
SPREAD = 32         # parts over which profiles meet


def rating_counts(ratings: DataFrame, dedup: bool = False) -> DataFrame:
    """Ratings per product (distinct raters with ``dedup``)."""
    if dedup:
        return user_product_multiplicity(ratings, True).groupBy("productId").agg(
            F.count(F.lit(1)).alias("count"))
    return ratings.groupBy("productId").agg(F.count(F.lit(1)).alias("count"))


def rating_with_count(ratings: DataFrame) -> DataFrame:
    r = ratings.select("userId", "productId", "score")
    return r.join(rating_counts(ratings), "productId")


def user_product_multiplicity(ratings: DataFrame, dedup: bool = False) -> DataFrame:
    """(userId, productId, m); with ``dedup`` a repeated rating counts once."""
    m = F.lit(1).cast("bigint") if dedup else F.count(F.lit(1))
    return ratings.groupBy("userId", "productId").agg(m.alias("m"))


def half_pairs(ratings: DataFrame, dedup: bool = False) -> DataFrame:
    """(product1 < product2, cocount) over all users."""
    m = user_product_multiplicity(ratings, dedup)
    return pair_sums(m, "userId", "productId", "m", out=("product1", "product2", "cocount"))


def cooccurrence(ratings: DataFrame, include_self: bool = True) -> DataFrame:
    """product1, product2, cocount, count1, count2 for every co-rated ordered pair.

    With ``include_self`` the table also has (p, p) rows, as a self-join on the
    user produces them.
    """
    pairs = both_ways(half_pairs(ratings))
    if include_self:
        m = user_product_multiplicity(ratings)
        diag = m.groupBy("productId").agg(F.sum(F.col("m") * F.col("m")).alias("cocount"))
        pairs = pairs.unionByName(diag.select(F.col("productId").alias("product1"),
                                              F.col("productId").alias("product2"),
                                              "cocount"))
    return with_counts(pairs, rating_counts(ratings))


def both_ways(half: DataFrame) -> DataFrame:
    """(product1 < product2, cocount) in either order."""
    return mirror(half, "product1", "product2", ["cocount"])


def with_counts(pairs: DataFrame, n: DataFrame) -> DataFrame:
    """``pairs`` with the rating counts of both products."""
    n1 = n.select(F.col("productId").alias("product1"), F.col("count").alias("count1"))
    n2 = n.select(F.col("productId").alias("product2"), F.col("count").alias("count2"))
    return pairs.join(n1, "product1").join(n2, "product2").select(
        "product1", "product2", "cocount", "count1", "count2")


def similarity(ratings: DataFrame, dedup: bool = False) -> DataFrame:
    """product1, product2, sim for every co-rated pair of distinct products.
    ``dedup`` counts each (user, product) once, which keeps sim <= 1."""
    return scored_pairs(half_pairs(ratings, dedup), rating_counts(ratings, dedup))


def scored_pairs(half: DataFrame, n: DataFrame) -> DataFrame:
    """(product1, product2, sim) in either order, from half pairs and rating counts."""
    n1 = n.select(F.col("productId").alias("product1"), F.col("count").alias("n1"))
    n2 = n.select(F.col("productId").alias("product2"), F.col("count").alias("n2"))
    scored = (half.join(n1, "product1").join(n2, "product2")
              .select("product1", "product2",
                      cooccurrence_sim("cocount", "n1", "n2").alias("sim")))
    return mirror(scored, "product1", "product2", ["sim"])


def similarity_above(ratings: DataFrame, threshold: float, dedup: bool = False) -> DataFrame:
    """(productId, simProductId, sim) with sim > threshold (9-place compare)."""
    s = similarity(ratings, dedup).where(rank_key("sim") > threshold)
    return s.select(F.col("product1").alias("productId"),
                    F.col("product2").alias("simProductId"), "sim")


def top_neighbours(ratings: DataFrame, k: int = ITEM_NEIGHBOURS,
                   dedup: bool = False, hot_items: int = HOT_ITEMS) -> DataFrame:
    """(productId, rank, simProductId, score): k most similar per product,
    ties broken by neighbour id.

    Users with more than ``hot_items`` products are left out of the pair join.  A pair that
    others co-rated gets what they add to its count; of the pairs that only they co-rated,
    the best come from comparing profiles: the count of a product and its multiplicity per
    such user.  A pair's full score is never below what these users alone give it, so the
    k best by either way hold the k best of all.  Exact.
    """
    m = user_product_multiplicity(ratings, dedup).where(F.col("productId").isNotNull() & F.col("userId").isNotNull())
    sizes = m.groupBy("userId").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_items)
    hot = sizes.orderBy(F.col("n").desc(), "userId").limit(HOT_USERS).collect()
    if not hot:
        return neighbours_of(similarity(ratings, dedup), k)
    shared_dir(ratings.sparkSession)
    users = [r.userId for r in hot]
    of_hot = F.array(*[F.coalesce(F.sum(F.when(F.col("userId") == u, F.col("m"))), F.lit(0)) for u in users])
    hot_rows = m.where(F.col("userId").isin(users)).groupBy("productId").agg(of_hot.alias("vec"))
    none = F.array(*[F.lit(0).cast("bigint") for _ in users])
    counts = rating_counts(ratings, dedup)
    profiles = (counts.join(hot_rows, "productId", "left")
                .select("productId", F.col("count").alias("n"), F.coalesce("vec", none).alias("vec")).checkpoint())
    rated = profiles.where(F.exists("vec", lambda x: x > 0))
    kinds = rated.groupBy("n", "vec").agg(F.min("productId").alias("first")).checkpoint()
    if kinds.count() ** 2 > sum(r.n ** 2 for r in hot):     # hardly any products alike
        return neighbours_of(similarity(ratings, dedup), k)

    def dot(a: str, b: str):
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0).cast("bigint"), lambda t, x: t + x)

    # Pairs that other users co-rated, with the hot users' share of their count.
    rest = pair_sums(m.where(~F.col("userId").isin(users)), "userId", "productId", "m", out=("product1", "product2", "cocount"))
    sides = [profiles.select(F.col("productId").alias(f"product{i}"), F.col("n").alias(f"n{i}"), F.col("vec").alias(f"vec{i}")) for i in (1, 2)]
    scored = rest.join(sides[0], "product1").join(sides[1], "product2").select(
        "product1", "product2", cooccurrence_sim(F.col("cocount") + dot("vec1", "vec2"), "n1", "n2").alias("sim"))
    met = neighbours_of(mirror(scored, "product1", "product2", ["sim"]), k).drop("rank")

    # Pairs of profiles: the k + 1 best kinds of products per kind, as a product may be among its own best.
    best = [rank_key("score").desc(), F.col("simProductId")]
    mine = kinds.select(F.col("n").alias("n1"), F.col("vec").alias("vec1"), F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("part"))
    others = kinds.select(F.col("n").alias("n2"), F.col("vec").alias("vec2"), F.col("first").alias("simProductId"),
                          F.pmod(F.xxhash64("n", "vec"), F.lit(SPREAD)).cast("int").alias("part"))
    like = mine.join(others, "part").withColumn("co", dot("vec1", "vec2")).where("co > 0").withColumn("score", cooccurrence_sim("co", "n1", "n2"))
    like = top_k_per_group(like, ["n1", "vec1"], best, k + 1).select("n1", "vec1", "n2", "vec2", "score")
    least = top_k_per_group(rated, ["n", "vec"], [F.col("productId")], k + 1).select(
        F.col("n").alias("n2"), F.col("vec").alias("vec2"), F.col("productId").alias("simProductId"))
    like = top_k_per_group(like.join(least, ["n2", "vec2"]), ["n1", "vec1"], best, k + 1).select("n1", "vec1", "simProductId", "score")
    alone = (rated.select("productId", F.col("n").alias("n1"), F.col("vec").alias("vec1")).join(like, ["n1", "vec1"])
             .where("productId <> simProductId").select("productId", "simProductId", "score"))
    both = met.unionByName(alone).groupBy("productId", "simProductId").agg(F.max("score").alias("score"))
    return top_k_per_group(both, ["productId"], best, k).select("productId", "rank", "simProductId", "score")


def neighbours_of(sims: DataFrame, k: int = ITEM_NEIGHBOURS) -> DataFrame:
    """(productId, rank, simProductId, score) of (product1, product2, sim)."""
    s = sims.select(F.col("product1").alias("productId"), F.col("product2").alias("simProductId"), F.col("sim").alias("score"))
    return top_k_per_group(s, ["productId"],
                           [rank_key("score").desc(), F.col("simProductId").asc()], k)


def product_recs(ratings: DataFrame, k: int = ITEM_NEIGHBOURS, dedup: bool = False) -> DataFrame:
    """Nested (productId, recs): every rated product, with an empty list when
    no other product shares a user with it."""
    nested = nest(top_neighbours(ratings, k, dedup), "productId")
    rated = rating_counts(ratings).select("productId")
    return (rated.join(nested, "productId", "left")
            .select("productId", F.coalesce("recs", empty_recs()).alias("recs")))
