"""Embedding whitening: projection on the leading eigenvectors, each to unit variance.

The covariance is summed in Spark as whole numbers: entries are scaled to integers and
centred by the rounded mean before they are multiplied, so every partial sum is exact
and no order of tasks changes it.  Only sums, one row per pair of dimensions, reach the
driver.  There LAPACK's single-precision eigenvectors are refined by Ogita and Aishima's
iteration, which is matrix products alone, first in double and at last in extended
precision.  Eigenvalues too close for it form clusters: each is solved on its own
subspace, after which the iteration goes on.

Edge cases: vectors that are null or hold null or non-finite entries are left out, and so
are empty ones; vectors of each length are a fit list of their own; scaled entries outside
+-2^62 count as that bound; a component without variance has a null ``whitened``, and takes
no part in ``identity_error``; a deviation outside 64 bits is null; null ids, repeated rows
and ties are rows like all others; an empty table gives an empty result; further columns
are not read.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
BATCH = 4096
_BOUND = 2.0 ** 62
_HALF = 1 << 60     # exact sums travel in two parts, as no column type holds them whole


# ---- vectors of a batch -------------------------------------------------------------

def scaled(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per vector length: (rows, floor(64 c) as whole numbers) of the usable vectors of an Arrow list column."""
    flat = column.flatten()
    lengths = np.asarray(column.value_lengths().fill_null(0))
    good = np.asarray(flat.is_valid()) & np.isfinite(np.asarray(flat.fill_null(0.0), float))
    ends = np.cumsum(lengths)
    bad_before = np.concatenate(([0], np.cumsum(~good)))
    usable = (lengths > 0) & (bad_before[ends] == bad_before[ends - lengths])
    values = np.clip(np.floor(np.where(good, np.asarray(flat.fill_null(0.0), float), 0.0) * SCALE), -_BOUND, _BOUND).astype(np.int64)
    found = []
    for dim in np.unique(lengths[usable]).tolist():
        rows = np.flatnonzero(usable & (lengths == dim))
        found.append((rows, values[(ends[rows] - dim)[:, None] + np.arange(dim)]))
    return found


def _parts(total: int) -> tuple[int, int]:
    return divmod(int(total), _HALF)


def _moments(y: np.ndarray) -> np.ndarray:
    """Sum of y_i y_j over rows, as exact Python integers."""
    small = np.abs(y).max(axis=1) < 1 << 20     # with at most 4096 rows every sum fits a double
    z = y[small].astype(float)
    total = (z.T @ z).astype(np.int64).astype(object)
    if not small.all():
        z = y[~small].astype(object)
        total = total + z.T @ z
    return total


# ---- sums over the table ------------------------------------------------------------

def _summed(vectors: DataFrame, start, add) -> DataFrame:
    """(dim, i, j, total parts): sums that tasks keep per vector length and send at their end."""
    def run(batches):
        from decimal import Decimal
        kept: dict[int, object] = {}
        for batch in batches:
            for rows, x in scaled(batch.column(0)):
                dim = x.shape[1]
                kept[dim] = add(kept.get(dim, start(dim)), x)
        for dim, total in kept.items():
            i, j = np.triu_indices(len(total)) if np.ndim(total) == 2 else (np.arange(len(total)), np.zeros(len(total), int))
            parts = [_parts(v) for v in (total[i, j] if np.ndim(total) == 2 else total)]
            whole = pa.decimal128(38, 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array([dim] * len(i), pa.int32()), pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                 pa.array([Decimal(p[0]) for p in parts], whole), pa.array([Decimal(p[1]) for p in parts], whole)],
                names=["dim", "i", "j", "hi", "lo"])

    sums = vectors.select("v").mapInArrow(run, "dim int, i int, j int, hi decimal(38,0), lo decimal(38,0)")
    return sums.groupBy("dim", "i", "j").agg(F.sum("hi").alias("hi"), F.sum("lo").alias("lo"))


def _collected(sums: DataFrame) -> dict[int, dict[tuple[int, int], int]]:
    """Exact sums by vector length; their number depends on the vectors' length alone."""
    out: dict[int, dict] = {}
    for r in sums.collect():
        out.setdefault(r.dim, {})[(r.i, r.j)] = int(r.hi) * _HALF + int(r.lo)
    return out


def totals(vectors: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Per vector length: the number of vectors and the sum of each dimension, without the offset."""
    def add(kept, x):
        # A row count first; sums of two halves of the numbers stay inside 64 bits.
        high, low = x >> 32, x & 0xFFFFFFFF
        sums = (high.sum(axis=0).astype(object) << 32) + low.sum(axis=0).astype(object)
        return [kept[0] + len(x), *(a + int(b) for a, b in zip(kept[1:], sums))]

    found = _collected(_summed(vectors, lambda dim: [0] * (dim + 1), add))
    return {dim: (t[(0, 0)], [t[(i + 1, 0)] for i in range(dim)]) for dim, t in found.items()}


def covariance(vectors: DataFrame, sums: dict[int, tuple[int, list[int]]]) -> dict[int, np.ndarray]:
    """Per vector length: the covariance with divisor n, as fractions."""
    centre = {dim: np.array([s // n for s in t], np.int64) for dim, (n, t) in sums.items()}

    def add(kept, x):
        for at in range(0, len(x), BATCH):
            kept = kept + _moments(_centred(x[at:at + BATCH], centre[x.shape[1]]))
        return kept

    found = _collected(_summed(vectors, lambda dim: np.zeros((dim, dim), object), add))
    out = {}
    for dim, (n, t) in sums.items():
        rest = [s - n * (s // n) for s in t]
        v = np.empty((dim, dim), object)
        for (i, j), m in found[dim].items():
            v[i, j] = v[j, i] = Fraction(n * m - rest[i] * rest[j], n * n)
        out[dim] = v
    return out


def _centred(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """x - centre as whole numbers; Python integers where 64 bits might not hold them."""
    if max(int(np.abs(x).max(initial=0)), int(np.abs(centre).max(initial=0))) < 1 << 61:
        return x - centre
    return x.astype(object) - centre.astype(object)


# ---- eigenvectors on the driver -----------------------------------------------------

def _extended(v: np.ndarray) -> np.ndarray:
    """Fractions as extended-precision numbers: a double and what it leaves over."""
    high = np.array([[float(x) for x in row] for row in v], float).reshape(v.shape)
    low = np.array([[float(x - Fraction(h)) for x, h in zip(row, hs)] for row, hs in zip(v, high.tolist())], float)
    return high.astype(np.longdouble) + low.reshape(v.shape)


def _refined(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """One step: new vectors, eigenvalues, the distance below which two of these count as one
    cluster, and the size of the correction.  All in the precision of the arguments."""
    r = np.eye(len(a), dtype=a.dtype) - x.T @ x
    s = x.T @ (a @ x)
    values = np.diag(s) / (1 - np.diag(r))
    off = s - np.diag(values)
    near = 2 * (np.sqrt((off * off).sum()) + np.abs(values).max() * np.sqrt((r * r).sum()))
    gap = values[None, :] - values[:, None]
    apart = np.abs(gap) > near
    e = np.where(apart, (s + values[None, :] * r) / np.where(apart, gap, 1), r / 2)
    return x + x @ e, values, near, float(np.abs(e).max())


def clusters(values: np.ndarray, near: float) -> list[np.ndarray]:
    """Index groups of two or more eigenvalues, each within ``near`` of the next."""
    order = np.argsort(values, kind="stable")
    breaks = np.flatnonzero(np.diff(values[order]) > near) + 1
    return [g for g in np.split(order, breaks) if len(g) > 1]


def _solved(a: np.ndarray, x: np.ndarray, group: np.ndarray) -> np.ndarray:
    """The vectors of a cluster, turned within their space: the small problem, shifted by the
    cluster's mean so that differences keep their digits, is solved in double precision."""
    q = x[:, group]
    shift = (np.diag(q.T @ (a @ q)) / np.diag(q.T @ q)).mean()
    small = q.T @ (a @ q - shift * q)
    size = np.abs(small).max()
    if not size > 0:
        return q
    _, turn = np.linalg.eigh(np.asarray((small + small.T) / (2 * size), float))
    return q @ turn.astype(a.dtype)


def _orthogonal(x: np.ndarray) -> np.ndarray:
    """Nearly orthonormal columns, orthonormal to the square of what was missing."""
    return x + x @ ((np.eye(len(x), dtype=x.dtype) - x.T @ x) / 2)


def eigen(a: np.ndarray, rounds: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix in extended precision."""
    size = np.abs(a).max(initial=0)
    if not size > 0:
        return np.zeros(len(a)), np.eye(len(a))
    unit = a / size
    _, start = np.linalg.eigh(unit.astype(np.float32))
    x = start.astype(float)
    # A step squares the error, so a small correction is the last one needed.
    for kind, enough in ((np.float64, 1e-6), (np.longdouble, 1e-9)):
        b, x = unit.astype(kind), x.astype(kind)
        for _ in range(rounds):
            x, values, near, change = _refined(b, x)
            found = clusters(values, near)
            if found:
                # Orthogonal again first, as a cluster's space must not lean on the others'.
                x = _orthogonal(x)
                for group in found:
                    x[:, group] = _solved(b, x, group)
            if change < enough:
                break
    x = _orthogonal(_orthogonal(x))
    values = np.diag(x.T @ (unit @ x)) / np.diag(x.T @ x)
    order = np.argsort(-values, kind="stable")
    x = x[:, order] / np.sqrt((x[:, order] ** 2).sum(axis=0))
    # Of a vector and its opposite, that with a positive largest entry.
    sign = np.sign(x[np.abs(x).argmax(axis=0), np.arange(len(x))])
    return np.asarray(values[order] * size, float), np.asarray(x * sign, float)


def fit(vectors: DataFrame, components: int = COMPONENTS) -> dict[int, dict]:
    """Per vector length: n, centre, rest (of the sums), projection and explained shares."""
    sums = totals(vectors)
    models = {}
    for dim, v in covariance(vectors, sums).items():
        n, t = sums[dim]
        values, x = eigen(_extended(v))
        k = min(components, dim)
        trace = float(sum(v[i, i] for i in range(dim)))
        varies = values[:k] > dim * 2.0 ** -50 * max(trace, 0.0)
        models[dim] = {
            "n": n, "centre": [s // n for s in t], "rest": [s - n * (s // n) for s in t], "varies": varies,
            "projection": x[:, :k] / np.sqrt(np.where(varies, values[:k], 1.0)),
            "explained": np.where(varies, values[:k] / (trace or 1.0), 0.0)}
    return models


# ---- rows ---------------------------------------------------------------------------

def whitened(x: np.ndarray, model: dict) -> np.ndarray:
    """Rows' projections: x - S/n, on the components, over the roots of their eigenvalues."""
    y = _centred(x, np.array(model["centre"], np.int64)).astype(float)
    return (y - np.array([Fraction(r, model["n"]) for r in model["rest"]], float)) @ model["projection"]


def deviations(x: np.ndarray, model: dict) -> list[int | None]:
    """Per row the exact sum of (n x - S)^2, null beyond 64 bits."""
    n = model["n"]
    y = _centred(x, np.array(model["centre"], np.int64))
    rough = float(np.abs(y).max(initial=0)) * n + n
    if y.dtype != object and x.shape[1] * rough * rough < 2.0 ** 62:
        e = y * n - np.array(model["rest"], np.int64)
        return (e * e).sum(axis=1).tolist()
    about = ((y.astype(float) * n - np.array(model["rest"], float)) ** 2).sum(axis=1)
    out: list[int | None] = [None] * len(y)
    for i in np.flatnonzero(about < 2.0 ** 64).tolist():
        total = sum((int(a) * n - r) ** 2 for a, r in zip(y[i].tolist(), model["rest"]))
        out[i] = total if total < 1 << 63 else None
    return out


def identity_errors(vectors: DataFrame, models: dict[int, dict]) -> dict[int, float]:
    """Per vector length: the largest entry of the whitened rows' covariance minus the identity,
    measured over all rows."""
    def run(batches):
        kept: dict[int, tuple] = {}
        for batch in batches:
            for _, x in scaled(batch.column(0)):
                w = whitened(x, models[x.shape[1]])
                s, m = kept.get(x.shape[1], (0.0, 0.0))
                kept[x.shape[1]] = (s + w.sum(axis=0), m + w.T @ w)
        for dim, (s, m) in kept.items():
            full = np.vstack([s, m])
            i, j = np.indices(full.shape)
            yield pa.RecordBatch.from_arrays(
                [pa.array([dim] * full.size, pa.int32()), pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()),
                 pa.array(full.ravel(), pa.float64())], names=["dim", "i", "j", "v"])

    found = (vectors.select("v").mapInArrow(run, "dim int, i int, j int, v double")
             .groupBy("dim", "i", "j").agg(F.sum("v").alias("v")).collect())
    out = {}
    for dim, model in models.items():
        k = len(model["varies"])
        full = np.zeros((k + 1, k))
        for r in found:
            if r.dim == dim:
                full[r.i, r.j] = r.v
        mean = full[0] / model["n"]
        error = np.abs(full[1:] / model["n"] - np.outer(mean, mean) - np.eye(k))
        out[dim] = float(error[np.ix_(model["varies"], model["varies"])].max(initial=0.0))
    return out


def whiten(embeddings: DataFrame, vec_id: str = "vec_id", vector: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) per usable row and component."""
    vectors = embeddings.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    vectors.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH))
    models = fit(vectors, components)
    errors = identity_errors(vectors, models)

    def run(batches):
        for batch in batches:
            for rows, x in scaled(batch.column(1)):
                model = models[x.shape[1]]
                k, m = len(model["varies"]), len(rows)
                w = whitened(x, model)
                unknown = np.broadcast_to(~model["varies"], w.shape).ravel()
                at = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows)).take(at), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                     pa.array(np.full(m * k, model["n"]), pa.int64()), pa.array(deviations(x, model), pa.int64()).take(at),
                     pa.array(w.ravel(), pa.float64(), mask=unknown), pa.array(np.tile(model["explained"], m), pa.float64()),
                     pa.array(np.full(m * k, errors[x.shape[1]]), pa.float64())],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.mapInArrow(run, "vec_id long, component int, n long, deviation long, whitened double, "
                                   "explained double, identity_error double")
