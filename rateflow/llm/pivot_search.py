"""Exact top-k search by inner product with pivot-table elimination.

Every vector's distances to a set of pivots are computed once and kept beside it.
By the triangle inequality |d(q, p) - d(c, p)| is a lower bound of d(q, c) for every
pivot p; the largest over many pivots gives an upper bound of the inner product,
(|q|^2 + |c|^2 - bound^2) / 2.  A query evaluates candidates in the order of that
bound and stops as soon as the next bound is below its k-th best score: exact.

Candidates lie in blocks of bounded size and queries (a stated set) in smaller
blocks.  A task holds a group of query blocks, as many as a stated number of bytes allows,
while a share of the candidate blocks passes by, so candidates are shuffled once per group
and not once per query block; only the k best per query leave a task.  Each query first
passes through one block alone, whose k-th score is where it starts in all others.

Edge cases: vectors that are null, empty, or hold null or non-finite components take
no part, nor do those with a scaled component of 2^62 or more, which no score in 64 bits
could come from; scores are exact whole numbers, those outside 64 bits count as that bound;
only vectors of the query's length are candidates; rows with the
query's vec_id are its own; a repeated query id asks once, for its least vector;
repeated candidate rows each count; ties go to the smaller vec_id; an empty table
gives an empty result; further columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from rateflow.llm.common import bucket_of, settled, small_batches

SCALE = 256
LIMIT = 1 << 62
LONGEST = (1 << 63) - 1
PIVOTS = 24
PIVOT_SAMPLE = 2000     # vectors that pivots are chosen from; only bounds depend on them
CANDIDATE_BLOCK = 4096
QUERY_BLOCK = 256
HELD_BYTES = 64 << 20       # queries that a task holds, about
PASSED_BYTES = 128 << 20    # candidates that pass by in one task, about
_FOUND = "query_id long, vec_id long, score long"
_BLOCK = "block long, ids array<long>, dim int, flat binary, table binary"


def scaled(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, v): floor(256 x) of each usable vector."""
    x = F.col(vector)
    usable = (x.isNotNull() & (F.size(x) > 0)
              & ~F.exists(x, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double") * SCALE) >= LIMIT)))
    return (vectors.where(F.coalesce(usable, F.lit(False)) & F.col(vec_id).isNotNull())
            .select(F.col(vec_id).cast("long").alias("vec_id"),
                    F.transform(x, lambda c: F.floor(c.cast("double") * SCALE).cast("long")).alias("v")))


def choose_pivots(sample: list[list[int]], count: int = PIVOTS) -> np.ndarray:
    """Pivots far from each other: each next one is farthest from those chosen."""
    x = np.array(sample, float)
    chosen = [0]
    far = ((x - x[0]) ** 2).sum(1)
    while len(chosen) < min(count, len(x)):
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((x - x[chosen[-1]]) ** 2).sum(1))
    return x[chosen]


def _packed(rows: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """One row per (block, dim): ids, vectors and their distances to the pivots.

    A block's size is bounded by the caller, who deals vectors by a hash.
    """
    def run(block):
        import pandas as pd
        dim = int(block["dim"].iloc[0])
        block = block.sort_values("vec_id", kind="stable")
        v = np.array(block["v"].tolist(), np.int64).reshape(len(block), dim)
        largest = np.abs(v).max()
        short = v.astype(np.int16 if largest < 1 << 15 else np.int32 if largest < 1 << 31 else np.int64)
        p = pivots[dim]
        distances = np.sqrt(np.stack([((v - q) ** 2).sum(1) for q in p], axis=1)).astype(np.float32)
        return pd.DataFrame([{"block": int(block["block"].iloc[0]), "ids": block["vec_id"].tolist(), "dim": dim,
                              "flat": short.tobytes(), "table": distances.tobytes()}])

    return rows.groupBy("block", "dim").applyInPandas(run, _BLOCK)


def eliminate(queries, candidates, k: int, start: list[int | None]) -> list[list[tuple[int, int]]]:
    """The k best (vec_id, score) of each query within one block of candidates.

    Both sides are (ids, vectors, pivot distances); ``start`` has scores that a
    result must reach, known from another block.
    """
    q_ids, q, q_table = queries
    ids, c, table = candidates
    q_norm, norm = (q.astype(float) ** 2).sum(1), (c.astype(float) ** 2).sum(1)
    # Scores are whole numbers; the shortest type that holds them all exactly is fastest,
    # and Python's own where none does.
    largest = float(np.abs(c).max(initial=0)) * float(np.abs(q).max(initial=0)) * c.shape[1]
    kind = np.float32 if largest < 2 ** 24 else np.float64 if largest < 2 ** 52 else np.int64 if largest < 2 ** 62 else object
    cc, qq = c.astype(kind), q.astype(kind)

    def dots(rows: np.ndarray, i: int) -> np.ndarray:
        s = cc[rows] @ qq[i]
        return s.astype(np.int64) if kind is not object else np.array([max(-LONGEST, min(LONGEST, x)) for x in s.tolist()], np.int64)

    columns, rows = np.ascontiguousarray(table.T, np.float32), q_table.astype(np.float32)
    # Rounding of distances must never lower an upper bound.
    slack = float(max(table.max(initial=0), q_table.max(initial=0))) * 2.0 ** -20
    apart, bound = np.empty(len(ids), np.float32), np.empty(len(ids), np.float32)
    results = []
    for i in range(len(q_ids)):
        bound[:] = 0
        for column, distance in zip(columns, rows[i]):
            np.subtract(column, distance, out=apart)
            np.abs(apart, out=apart)
            np.maximum(bound, apart, out=bound)
        least_apart = np.maximum(bound.astype(np.float64) - slack, 0)
        upper = (q_norm[i] + norm - least_apart * least_apart) / 2 + 1e-6 * (q_norm[i] + norm) + 1
        alive = np.flatnonzero((ids != q_ids[i]) if start[i] is None else (ids != q_ids[i]) & (upper >= start[i]))
        order = alive[np.argsort(-upper[alive])]
        scores, found = np.zeros(0, np.int64), np.zeros(0, np.int64)
        least, at, step = start[i], 0, 256
        while at < len(order) and (least is None or upper[order[at]] >= least):
            chunk = order[at:at + step]
            new = dots(chunk, i)
            if least is not None:
                chunk, new = chunk[new >= least], new[new >= least]
            scores, found = np.concatenate([scores, new]), np.concatenate([found, ids[chunk]])
            if len(scores) > k:
                best = np.lexsort((found, -scores))[:k]
                scores, found = scores[best], found[best]
            if len(scores) == k:
                least = int(scores.min()) if least is None else max(least, int(scores.min()))
            at, step = at + step, 2 * step
        results.append(list(zip(found.tolist(), scores.tolist())))
    return results


def _unpack(ids, dim, flat, table):
    n = len(ids)
    return (np.array(ids, np.int64), np.frombuffer(flat, f"i{len(flat) // (n * dim)}").reshape(n, dim),
            np.frombuffer(table, np.float32).reshape(n, -1))


class _Held:
    """A block of queries and the k best of each among the candidates that passed by."""

    def __init__(self, r, k: int):
        self.number, self.k = r.block, k
        self.queries = _unpack(r.ids, r.dim, r.flat, r.table)
        known = dict(zip(r.start_ids, r.start_scores)) if r.start_ids is not None else {}
        n = len(r.ids)
        self.start = [known.get(x) for x in self.queries[0].tolist()]
        self.ids, self.scores, self.count = np.zeros((n, k), np.int64), np.zeros((n, k), np.int64), np.zeros(n, np.int64)

    def meet(self, candidates) -> None:
        for i, new in enumerate(eliminate(self.queries, candidates, self.k, self.start)):
            if new:
                old = zip(self.ids[i, :self.count[i]].tolist(), self.scores[i, :self.count[i]].tolist())
                best = sorted([*old, *new], key=lambda x: (-x[1], x[0]))[:self.k]
                self.count[i] = len(best)
                self.ids[i, :len(best)], self.scores[i, :len(best)] = zip(*best)
                if len(best) == self.k:
                    self.start[i] = best[-1][1] if self.start[i] is None else max(self.start[i], best[-1][1])

    def found(self):
        i, j = np.nonzero(np.arange(self.k) < self.count[:, None])
        return self.queries[0][i], self.ids[i, j], self.scores[i, j]


def _search(queries: DataFrame, candidates: DataFrame, k: int, cells: int, round_of: int = 0) -> DataFrame:
    """The k best per query within each cell (g, c) of queries and candidates of one length.

    With ``round_of`` blocks that a first pass went round, a query leaves out the one that it met there.
    """
    def run(batches):
        import pandas as pd

        def told(held):
            return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), map(np.concatenate, zip(*[q.found() for q in held])))))

        held, cell = [], None
        for frame in batches:
            for r in frame.itertuples(index=False):
                if (r.g, r.c, r.dim) != cell:
                    if held:
                        yield told(held)
                    held, cell = [], (r.g, r.c, r.dim)
                if r.side == 0:
                    held.append(_Held(r, k))
                elif held:
                    block = _unpack(r.ids, r.dim, r.flat, r.table)
                    for q in held:
                        if not round_of or r.block != q.number % round_of:
                            q.meet(block)
        if held:
            yield told(held)

    no_ids = F.lit(None).cast("array<long>")
    both = queries.withColumn("side", F.lit(0)).unionByName(
        candidates.withColumns({"side": F.lit(1), "start_ids": no_ids, "start_scores": no_ids}))
    # Few rows but much work: more partitions than cells, so that few cells share one.
    n = 4 * max(cells, queries.sparkSession.sparkContext.defaultParallelism)
    return both.repartition(n, "g", "c", "dim").sortWithinPartitions("g", "c", "dim", "side").mapInPandas(run, _FOUND)


def _sample(rows: DataFrame, n: int) -> list[list[int]]:
    """PIVOT_SAMPLE of n vectors, or a few less, by a hash: each task tells the driver its share of them only."""
    parts = 1 << 40
    hashed = rows.select("v", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(parts)).alias("hash"))
    few = hashed.where(F.col("hash") < min(parts, max(1, parts * 2 * PIVOT_SAMPLE // max(n, 1)))).orderBy("hash").limit(PIVOT_SAMPLE)
    return [r["v"] for r in few.select("v").collect()]


def top_k(vectors: DataFrame, is_query, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The k candidates of the highest inner product for each query row.

    ``is_query`` is a condition over ``vec_id``; all rows are candidates of all queries but their own.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    rows = scaled(vectors, vec_id, vector).withColumn("dim", F.size("v"))
    per_dim = {r["dim"]: r["n"] for r in rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    pivots = {dim: choose_pivots(_sample(rows.where(F.col("dim") == dim), n)) for dim, n in per_dim.items()}
    queries = rows.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))
    n_blocks = max(1, -(-sum(per_dim.values()) // CANDIDATE_BLOCK))
    n_query_blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    row_nr = F.monotonically_increasing_id()
    candidates = settled(_packed(rows.withColumn("block", bucket_of(n_blocks, F.lit(1), "vec_id", row_nr)), pivots))
    asked = settled(_packed(queries.withColumn("block", bucket_of(n_query_blocks, F.lit(2), "vec_id")), pivots))
    no_ids, zero = F.lit(None).cast("array<long>"), F.lit(0).cast("long")
    # A first pass over one block each, dealt round the blocks, finds starting scores.
    met = min(n_blocks, n_query_blocks)
    first = asked.withColumns({"g": F.pmod("block", F.lit(n_blocks)), "c": zero, "start_ids": no_ids, "start_scores": no_ids})
    started = settled(_search(first, candidates.where(F.col("block") < met).withColumns({"g": F.col("block"), "c": zero}), k, met))
    starts = (started.groupBy("query_id").agg(F.min("score").alias("score"), F.count(F.lit(1)).alias("n")).where(F.col("n") == k)
              .withColumn("block", bucket_of(n_query_blocks, F.lit(2), "query_id")).groupBy("block")
              .agg(F.collect_list(F.struct("query_id", "score")).alias("s"))
              .select("block", F.col("s.query_id").alias("start_ids"), F.col("s.score").alias("start_scores")))
    longest = max(per_dim, default=0)
    group = max(1, HELD_BYTES // (QUERY_BLOCK * (8 * longest + 4 * PIVOTS + 32 * k)))     # query blocks of a group
    groups = -(-n_query_blocks // group)
    chunks = min(n_blocks, max(-(-4 * spark.sparkContext.defaultParallelism // groups),
                               -(-n_blocks * CANDIDATE_BLOCK * 4 * (longest + PIVOTS) // PASSED_BYTES)))
    each = F.explode(F.sequence(zero, F.lit(chunks - 1).cast("long")))
    rest = asked.join(starts, "block", "left").withColumns({"g": F.floor(F.col("block") / group), "c": each})
    every = F.explode(F.sequence(zero, F.lit(groups - 1).cast("long")))
    others = candidates.withColumns({"g": every, "c": F.pmod("block", F.lit(chunks))})
    found = started.union(_search(rest, others, k, groups * chunks, round_of=n_blocks))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
             list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, rank, vec_id, score FROM
    (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
WHERE rank <= 5
"""
