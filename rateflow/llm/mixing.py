"""Mixing sources to target weights by cube-method balanced sampling.

Each source has a target number of words.  A document is taken ``floor(p)`` times,
and once more with probability ``p - floor(p)``, where p is its source's target over
its size.  That last choice is drawn by the cube method: the vector of fractional
inclusion probabilities moves through the null space of the balancing constraints
(word total and document total), each move making one of them 0 or 1, until a dozen
are left in a source; these are landed by the rounding that misses the totals least.

In Spark the flight runs per (source, block): blocks hold some thousand documents,
dealt by a hash of the row and its number among equal ones, so a source, or a row, with
a third of all rows is many blocks.
What a block cannot settle (two documents) flies on in the next level, where a
thousand blocks meet, up to one last block per source that lands.

Edge cases: a null text has size 0; the null source is a source of its own, last in
order; a source without words has target 0 and its documents are taken 0 times;
repeated rows are separate draws; an empty table gives an empty result; further
columns are not read.  Reruns give the same draws: blocks, order and random numbers
all come from hashes of the rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from rateflow.llm.common import bucket_of, settled, word_count

WEIGHTS = (3, 1, 2)
SHARE = 1.5      # words of the mix over words of all sources
MOST = 2.0       # a target's limit over its source's size
BLOCK = 4096     # documents that fly together at first
MERGE = 1024     # blocks whose rest flies together at the next level
LANDING = 12     # documents of a source whose rounding is searched at the end
SALTS = 64       # a hot source's rows meet its target in so many tasks
SEED = 11
EQUALS = 1024    # equal rows are counted and dealt again in groups of so many
_DRAW = "row long, doc_id long, no_id boolean, source string, size long, source_size long, target double, block long, last boolean, p double, copies long"


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """One row per source: its size, target in words and number of documents.

    The sources, by code point and null last, weigh ``weights`` in turn.  Targets fill
    up like water: weight times one level, but at most ``most`` times the size, with
    the level set so that they add up to ``share`` of all words.  The sources that hit
    their limit are those of the smallest size per weight, so the level follows from
    running sums over the sources in that order.
    """
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("documents"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (rank % len(weights) + 1).cast("int"))
    ranked = per_source.select("*", weight.alias("weight")).withColumn("limit", F.col("source_size") * most)
    fill = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    level = ((F.sum("source_size").over(everything) * share - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
             / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    # A source is at its limit if the level reached just before it is above it; the
    # level at the first source that is not holds for it and all later ones.
    leveled = ranked.withColumn("own_level", level)
    full = F.col("own_level") * F.col("weight") >= F.col("limit")
    common = F.min_by("own_level", F.when(~full, F.col("limit") / F.col("weight"))).over(everything)
    target = F.when(full, F.col("limit")).otherwise(F.least(common * F.col("weight"), F.col("limit")))
    return leveled.select("source", "source_size", "documents", target.alias("target"))


def fly(p: np.ndarray, size: np.ndarray, rng: np.random.Generator, rest: int = 0) -> np.ndarray:
    """Flight phase: move fractional probabilities until at most two (or ``rest``) stay fractional.

    Three documents at a time, as two constraints (words and documents) leave one
    direction of movement for three.  Both moves along it keep the sums of p and of
    p * size; which one is taken is drawn so that each p keeps its expectation.
    """
    p = p.astype(float).copy()
    eps = 1e-9
    waiting = [int(k) for k in np.flatnonzero((p > eps) & (p < 1 - eps))][::-1]
    active: list[int] = []
    draws = iter(rng.random(len(waiting) + 4).tolist())
    while True:
        while len(active) < 3 and waiting:
            active.append(waiting.pop())
        if len(active) < 2 or len(active) + len(waiting) <= rest:
            break
        s = [float(size[k]) for k in active]
        if len(active) == 3:
            u = [s[1] - s[2], s[2] - s[0], s[0] - s[1]]
            if not any(u):
                u = [1.0, -1.0, 0.0]
        elif s[0] == s[1]:
            u = [1.0, -1.0]
        else:
            break
        up = min((1 - p[k]) / d if d > 0 else p[k] / -d for k, d in zip(active, u) if d)
        down = min(p[k] / d if d > 0 else (1 - p[k]) / -d for k, d in zip(active, u) if d)
        step = up if next(draws, 0.5) < down / (up + down) else -down
        for k, d in zip(active, u):
            p[k] += step * d
            if p[k] < eps:
                p[k] = 0.0
            elif p[k] > 1 - eps:
                p[k] = 1.0
        active = [k for k in active if 0 < p[k] < 1]
    return p


def land(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Landing phase: of all roundings of the few values left, the nearest to the word total, then to the document total."""
    left = np.flatnonzero((p > 0) & (p < 1))
    if not len(left):
        return p
    options = (np.arange(1 << len(left))[:, None] >> np.arange(len(left))) & 1
    words = np.abs(options @ size[left] - p[left] @ size[left])
    number = np.abs(options.sum(1) - p[left].sum())
    p = p.copy()
    p[left] = options[np.lexsort((number, words))[0]]
    return p


def _level(level: int, seed: int):
    """Flight of one block; a source's only block also lands."""
    def run(block: pd.DataFrame) -> pd.DataFrame:
        # Large documents last: the roundings of these few reach almost any word total.
        block = block.sort_values(["size", "row", "no_id", "doc_id"], kind="stable")
        source = block["source"].iloc[0]
        key = f"{seed}/{level}/{source is None}/{source}/{block['block'].iloc[0]}"
        rng = np.random.default_rng(zlib.crc32(key.encode()))
        size = block["size"].to_numpy()
        last = block["last"].iloc[0]
        p = fly(block["p"].to_numpy(), size, rng, LANDING if last else 0)
        if last:
            p = land(p, size)
        done = (p <= 0) | (p >= 1)
        block["copies"] = (block["copies"] + np.where(done, p, 0)).astype("int64")
        block["p"] = np.where(done, 0.0, p)
        return block
    return run


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED) -> DataFrame:
    """Per document: size, its source's size and target, the copies and words taken.

    Also carries ``row``, a hash of (doc_id, text), by which callers find the row again.
    """
    sized = docs.select(F.xxhash64(F.col(doc_id), F.col(text)).alias("row"), F.col(doc_id).cast("long").alias("doc_id"),
                        F.col(source).alias("source"), word_count(F.col(text)).alias("size"))
    return draw(sized, weights, share, most, seed)


def draw(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED) -> DataFrame:
    """The mix over rows (row, doc_id, source, size) whose sizes are known."""
    targets = source_targets(sized, weights, share, most)
    # Every source's target row is copied to each salt, so that a hot source's
    # documents meet it in many tasks.
    salted = targets.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    # Equal rows are counted before the shuffle and dealt again by their number, so that they
    # spread over the blocks, the same way on every run.  A null id travels as a flag, as it would
    # make pandas round the ids beside it.
    counted = (sized.select("row", F.coalesce("doc_id", F.lit(0)).alias("doc_id"), F.col("doc_id").isNull().alias("no_id"), "source", "size")
               .groupBy("row", "doc_id", "no_id", "source", "size").agg(F.count(F.lit(1)).alias("equals")))
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("equals") - 1) / EQUALS)))
    left = (counted.withColumn("part", part)
            .withColumn("salt", bucket_of(SALTS, F.lit(3), "row", "part").cast("int")).alias("d"))
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(F.col("ratio") + 1e-9)
    blocks = F.ceil(F.col("documents") / BLOCK)
    rows = (left.join(salted.alias("t"), (F.col("d.salt") == F.col("t.salt")) & F.col("d.source").eqNullSafe(F.col("t.source")))
            .select("d.row", "d.doc_id", "d.no_id", "d.source", "d.size", "t.source_size", "t.target", "t.documents", ratio.alias("ratio"),
                    F.explode(F.sequence(F.col("d.part") * EQUALS + 1, F.least("d.equals", (F.col("d.part") + 1) * EQUALS))).alias("nth"))
            .select("row", "doc_id", "no_id", "source", "size", "source_size", "target",
                    F.when(F.col("nth") == 1, bucket_of(blocks, F.lit(5), "row")).otherwise(
                        bucket_of(blocks, F.lit(5), "row", "nth")).alias("block"),
                    (F.col("documents") <= BLOCK).alias("last"),
                    F.greatest(F.col("ratio") - whole, F.lit(0.0)).alias("p"), whole.cast("long").alias("copies"))
            .withColumn("p", F.when(F.col("p") < 1e-9, 0.0).otherwise(F.col("p"))))
    done, level = [], 0
    while True:
        # Each level is written to the shared checkpoint folder: a lost executor
        # repeats a level at most, and both its outputs come from one computation.
        rows = settled(rows.groupBy("source", "block").applyInPandas(_level(level, seed), _DRAW))
        done.append(rows.where("p = 0"))
        rest = rows.where("p > 0")
        blocks = rest.agg(F.max("block")).first()[0]
        if blocks is None:
            break
        rows, level = rest.withColumn("block", F.floor(F.col("block") / MERGE)).withColumn("last", F.lit(blocks < MERGE)), level + 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("row", F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"), "source", "size", "source_size", "target", "copies",
                      (F.col("copies") * F.col("size")).alias("taken"))


def copies_column(copies: Column) -> Column:
    """An array with one element per copy, for exploding rows into the mix."""
    return F.when(copies > 0, F.sequence(F.lit(1).cast("long"), copies)).otherwise(F.array().cast("array<bigint>"))
