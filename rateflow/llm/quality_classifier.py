"""Supervised subword embeddings for document quality.

Each word stands for itself and for its character n-grams, all hashed into one
table of learned vectors; neighbouring words add a hashed pair.  A document is the
mean of its vectors, followed by a softmax, trained by numpy stochastic gradient
descent.  As the softmax input is linear in that mean, scoring folds vectors and
output weights into one number per bucket (a table of fixed size, shipped to the
tasks), and a document's score is read off one scan without a shuffle.

Edge cases: a null or empty text has the zero vector, so its score is that of the
bias; labels that are null or belong to no document teach nothing; of labels that
contradict each other the larger holds; a null doc_id is never held out; with no
usable label, or one class only, every score is that class's (0.5 without labels);
repeated rows score alike; further columns pass through.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F, types as T

from rateflow.llm.common import BLANK, append_columns, code_points, word_codes

GRAMS = 1 << 17            # vectors of words and n-grams
PAIRS = 1 << 12            # vectors of pairs of neighbouring words, before the others
BUCKETS = PAIRS + GRAMS
DIM = 8
EPOCHS = 5
RATE = 0.5
SEED = 7
# Documents that the model is fitted on: those with the smallest hash of their id.
MAX_TRAIN_DOCS = 2500

_P, _Q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _gram(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _Q
    return PAIRS + ((h >> np.uint64(40)) & np.uint64(GRAMS - 1)).astype(np.int64)


def buckets(text: str | None) -> np.ndarray:
    """The buckets of a whole text's words, character n-grams and word pairs.

    Works on code points, with every run of white space as one blank, which marks the
    ends of words: n-grams of 3 and 4 have blanks at their ends only.  Equal
    neighbours always make pair 0, so repeated words are one feature.
    """
    a = code_points(text)
    blank = a == BLANK
    words = word_codes(a)
    if not len(words):
        return np.zeros(0, np.int64)
    three = (a[:-2] * _P + a[1:-1]) * _P + a[2:]
    four = three[:-1] * _P + a[3:]
    pairs = (words[1:] ^ words[:-1]) * _Q >> np.uint64(52)
    return np.concatenate([
        pairs.astype(np.int64), _gram(words * _Q + np.uint64(1)), _gram(three[~blank[1:-1]]),
        _gram(four[~(blank[1:-2] | blank[2:-1])] + np.uint64(2))])


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a whole text and how often each occurs."""
    found, times = np.unique(buckets(text), return_counts=True)
    return found.astype(np.int32), times.astype(np.float32)


def fit(examples: list[tuple[str | None, int]]) -> tuple[np.ndarray, float]:
    """Weights per bucket and the bias of the log-odds of label 1.

    Plain stochastic gradient descent over vectors and softmax weights with a rate
    that falls to 0; the order of the examples is drawn from a fixed seed.
    """
    rng = np.random.default_rng(SEED)
    labels = [int(y) for _, y in examples]
    if len(set(labels)) < 2:
        return np.zeros(BUCKETS), 0.0 if not labels else (20.0 if labels[0] else -20.0)
    data = [(ids, times / times.sum(), y) for (ids, times), y in zip((features(t) for t, _ in examples), labels)
            if len(ids)]
    vectors = ((rng.random((BUCKETS, DIM)) - 0.5) / DIM).astype(np.float32)
    out = np.zeros((DIM, 2), np.float32)
    bias = np.zeros(2, np.float32)
    step, steps = 0, max(1, EPOCHS * len(data))
    for _ in range(EPOCHS):
        for k in rng.permutation(len(data)):
            ids, share, y = data[k]
            rate = RATE * (1 - step / steps)
            step += 1
            rows = vectors[ids]
            mean = share @ rows
            z = mean @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            back = out @ p
            out -= rate * np.outer(mean, p).astype(np.float32)
            bias -= rate * p * 0.1
            # The usual form of this model gives each vector the whole gradient, not
            # its share, times the vector's number of occurrences over the largest.
            vectors[ids] = rows - rate * np.outer(share / share.max(), back).astype(np.float32)
    return (vectors.astype(np.float64) @ (out[:, 1] - out[:, 0]).astype(np.float64)), float(bias[1] - bias[0])


def probability(text: str | None, weights: np.ndarray, bias: float) -> float:
    """Probability of label 1 for a whole text, by the folded weights."""
    found = buckets(text)
    z = bias + (float(weights[found].mean()) if len(found) else 0.0)
    return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from training: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
          label: str = "quality", max_docs: int = MAX_TRAIN_DOCS) -> tuple[np.ndarray, float]:
    """Fit on at most ``max_docs`` labelled documents that are not held out.

    The sample is that of the smallest id hashes, so it does not depend on the order
    of rows; only it reaches the driver.
    """
    known = (labels.select(F.col(doc_id).alias("doc_id"), F.col(label).alias("y"))
             .where(F.col("y").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("y").alias("y")))
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    here = known.join(texts.select("doc_id"), "doc_id", "left_semi")
    chosen = here.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)
    # At most max_docs ids: small enough to ship to every task.
    # A repeated id teaches once, a null text before others, then the least.
    one = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(
        F.max("y").alias("y"), F.max(F.col("text").isNull()).alias("none"), F.min("text").alias("text"))
    rows = one.select("doc_id", F.when(~F.col("none"), F.col("text")).alias("text"), "y").collect()
    rows.sort(key=lambda r: r["doc_id"])
    return fit([(r["text"], r["y"]) for r in rows])


def score(docs: DataFrame, model: tuple[np.ndarray, float], text: str = "text",
          name: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 for every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def start():
        weights, bias = shared.value
        return lambda batch: [[probability(t, weights, bias) for t in batch.column(at).to_pylist()]]

    return append_columns(docs, [T.StructField(name, T.DoubleType())], start)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score and predicted (1 from a score of 0.5)."""
    model = train(docs, labels)
    scored = score(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
