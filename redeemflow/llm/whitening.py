"""Embedding whitening by QDWH spectral divide and conquer.

The covariance of the distinct quantised vectors is added up in tasks.  Its
eigenvectors come from polar decompositions: for a shift s inside the spectrum
the polar factor U of A - sI gives the projector (I + U) / 2 on the space of the
eigenvalues above s, an orthonormal basis of that space and of its complement
splits A into two blocks, and each block is split again until it is one
component (or a multiple of the identity, where any basis will do).  The polar
factor comes from the dynamically weighted Halley iteration in its QR form.

The whitening matrix (dimension x components) is small and goes to every task.
"""

from __future__ import annotations

import json
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from redeemflow.llm.common import fold, written

EPS = np.finfo(float).eps
#: eigenvalues below this share of the trace count as none
RANK_TOLERANCE = 1e-12
#: rows of one matrix product
ROWS = 4096


# ----------------------------------------------------------------- eigenvectors
def polar_factor(a: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix by dynamically weighted Halley
    iterations: about six for condition numbers up to 1e16."""
    n = len(a)
    x = a / np.linalg.norm(a)  # the Frobenius norm bounds the largest singular value
    try:
        low = max(1 / np.linalg.norm(np.linalg.inv(x)), EPS)  # and that of the inverse the smallest
    except np.linalg.LinAlgError:
        low = EPS
    eye = np.eye(n)
    for _ in range(60):
        low = min(low, 1.0)
        square = low * low
        d = np.cbrt(4 * (1 - square) / (square * square))
        root = np.sqrt(1 + d)
        wa = root + np.sqrt(max(8 - 4 * d + 8 * (2 - square) / (square * root), 0.0)) / 2
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))
        new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        new = (new + new.T) / 2
        low = low * (wa + wb * square) / (1 + wc * square)
        moved, x = np.linalg.norm(new - x), new
        if moved <= np.cbrt(EPS) * 1e-3 and abs(1 - low) < 1e-8:
            break
    return x


def _basis(projector: np.ndarray, k: int) -> np.ndarray:
    """Orthonormal columns: the first ``k`` span the projector's range, the others its
    complement.  Columns are taken largest first (a pivoted QR), then completed and
    polished by one step of subspace iteration."""
    n = len(projector)
    work, picked = projector.copy(), []
    for _ in range(k):
        j = int(np.argmax((work * work).sum(axis=0)))
        v = work[:, j] / np.linalg.norm(work[:, j])
        picked.append(v)
        work -= np.outer(v, v @ work)
    inside = np.linalg.qr(projector @ np.array(picked).T)[0]
    return np.linalg.qr(np.hstack([inside, np.eye(n)]))[0]


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix."""
    scale = np.linalg.norm(a)
    values, vectors = _split((a + a.T) / 2, scale)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


def _split(a: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray]:
    n = len(a)
    off = a - np.diag(np.diag(a))
    if n == 1 or np.linalg.norm(off) <= EPS * scale:
        return np.diag(a).copy(), np.eye(n)  # diagonal already: every axis is a component
    for shift in _shifts(a):
        moved = a - shift * np.eye(n)
        if np.linalg.norm(moved) <= EPS * scale:
            return np.diag(a).copy(), np.eye(n)
        projector = (polar_factor(moved) + np.eye(n)) / 2
        k = int(round(np.trace(projector)))
        if not 0 < k < n:
            continue
        v = _basis(projector, k)
        b = v.T @ a @ v
        if np.linalg.norm(b[k:, :k]) <= 1e-11 * scale:
            parts = [_split((x + x.T) / 2, scale) for x in (b[:k, :k], b[k:, k:])]
            vectors = np.hstack([v[:, :k] @ parts[0][1], v[:, k:] @ parts[1][1]])
            return np.concatenate([parts[0][0], parts[1][0]]), vectors
    raise ValueError("no shift splits the spectrum")


def _shifts(a: np.ndarray):
    """Shifts to try: the median of the diagonal, then points between its ends.  A shift
    on an eigenvalue, or outside the spectrum, gives no projector."""
    d = np.sort(np.diag(a))
    yield float(np.median(d))
    off = np.abs(a - np.diag(np.diag(a))).sum(axis=1).max()
    for share in (0.5, 0.25, 0.75, 0.382, 0.618, 0.1, 0.9, 0.03, 0.97):
        yield float(d[0] + share * (d[-1] - d[0]))
    for share in (0.5, 0.3, 0.7, 0.15, 0.85, 0.05, 0.95):  # the discs that hold the spectrum
        yield float(d[0] - off + share * (d[-1] - d[0] + 2 * off))


def components(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenpairs above the rank tolerance, polished to double precision.

    Rounding of the nested splits leaves small entries off the diagonal of V'AV; two
    first-order corrections (entry over gap) remove them.
    """
    values, v = eigen(covariance)
    total = float(np.trace(covariance))
    v = np.linalg.qr(v)[0]
    for _ in range(2):
        b = v.T @ covariance @ v
        d = np.diag(b).copy()
        gap = d[None, :] - d[:, None]
        close = np.abs(gap) <= 1e-9 * abs(total)
        step = np.where(close, 0.0, b / np.where(close, 1.0, gap))
        np.fill_diagonal(step, 0.0)
        v = np.linalg.qr(v + v @ step)[0]
    values = np.einsum("ij,ij->j", v, covariance @ v)
    order = np.argsort(-values, kind="stable")
    keep = order[values[order] > RANK_TOLERANCE * max(total, 0.0)]
    return values[keep], v[:, keep]


# ------------------------------------------------------------------------ Spark
class Whitening(NamedTuple):
    n: int
    sums: tuple[int, ...]
    values: np.ndarray      # eigenvalues of the components kept
    vectors: np.ndarray     # dimension x components
    trace: float


def quantised(embedding: Column, scale: int = 256) -> Column:
    """Entries as long: floor of ``scale`` times the entry as double."""
    return F.transform(embedding, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast("long"))


def usable(embedding: Column) -> Column:
    bad = F.exists(embedding, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == F.lit(float("inf"))))
    return embedding.isNotNull() & ~bad


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _one(data) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["data"])


def _sums(batches):
    n, sums = 0, None
    for b in batches:
        if b.num_rows:
            part = _exact_sums(b)
            n, sums = n + b.num_rows, part if sums is None else [x + y for x, y in zip(sums, part)]
    if n:
        yield _one(json.dumps([n, sums]).encode())


def _exact_sums(batch) -> list[int]:
    """Sums per dimension as Python integers, by halves so that no addition overflows."""
    x = _matrix(batch.column(0))
    return [(int(h) << 32) + int(l) for h, l in zip((x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0))]


def _merge_sums(batches):
    n, sums = 0, None
    for b in batches:
        for data in b.column(0).to_pylist():
            m, part = json.loads(data)
            n, sums = n + m, part if sums is None else [x + y for x, y in zip(sums, part)]
    if n:
        yield _one(json.dumps([n, sums]).encode())


def _products(batches, mean, vectors=None):
    """Sum of outer products of the centred vectors (of their projections)."""
    total = None
    for b in batches:
        x = _matrix(b.column(0))
        for i in range(0, len(x), ROWS):
            y = x[i:i + ROWS] - mean
            if vectors is not None:
                y = y @ vectors
            total = y.T @ y if total is None else total + y.T @ y
    if total is not None:
        yield _one(total.tobytes())


def _merge_products(batches):
    total = None
    for b in batches:
        for data in b.column(0).to_pylist():
            part = np.frombuffer(data)
            total = part.copy() if total is None else total + part
    if total is not None:
        yield _one(total.tobytes())


def _covariance(fit: DataFrame, n: int, mean: np.ndarray, vectors: np.ndarray | None = None) -> np.ndarray:
    data = fold(fit.mapInArrow(lambda it: _products(it, mean, vectors), "data binary"), _merge_products,
                "data binary").first()["data"]
    total = np.frombuffer(bytes(data))
    side = round(len(total) ** 0.5)
    return total.reshape(side, side) / n


def fit_whitening(fit: DataFrame) -> Whitening | None:
    """Whitening of the vectors of ``x`` (arrays of long of one length); None without rows.

    The driver holds the covariance, dimension squared numbers, and nothing that grows
    with the rows.
    """
    row = fold(fit.mapInArrow(_sums, "data binary"), _merge_sums, "data binary").first()
    if row is None:
        return None
    n, sums = json.loads(bytes(row["data"]))
    mean = np.array([s / n for s in sums])
    v = _covariance(fit, n, mean)
    values, vectors = components(v)
    return Whitening(n, tuple(sums), values, vectors, float(np.trace(v)))


_OUT = ("vec_id long, component int, n long, deviation long, whitened double, explained double, "
        "identity_error double")


def _deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """Sum over dimensions of (n x - S)^2, exact; None beyond a long."""
    reach = max((abs(n * int(v) - s) for m in (x.min(axis=0), x.max(axis=0)) for v, s in zip(m, sums)), default=0)
    largest = max(abs(int(x.min())), abs(int(x.max())), 1)
    if n * largest < 2 ** 62 and max(map(abs, sums)) < 2 ** 62 and reach * reach * len(sums) < 2 ** 62:
        d = n * x - np.array(sums, np.int64)
        return (d * d).sum(axis=1).tolist()
    exact = (sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist())
    return [e if e < 2 ** 63 else None for e in exact]


def _whiten(batches, w: Whitening, matrix: np.ndarray, explained: np.ndarray, error: float):
    names = [f.split(" ")[0] for f in _OUT.split(", ")]
    mean = np.array([s / w.n for s in w.sums])
    k = matrix.shape[1]
    for b in batches:
        for i in range(0, b.num_rows, ROWS):
            part = b.slice(i, ROWS)
            x = _matrix(part.column(1))
            deviation = _deviations(x, w.n, w.sums)
            m = len(x) * k
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(np.repeat(np.arange(len(x)), k))),
                 pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                 pa.array(np.full(m, w.n, np.int64)),
                 pa.array([d for d in deviation for _ in range(k)], pa.int64()),
                 pa.array(((x - mean) @ matrix).ravel()),
                 pa.array(np.tile(explained, len(x))),
                 pa.array(np.full(m, error))], names)


def whiten(embeddings: DataFrame, components: int = 4, scale: int = 256) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` per usable
    row and component, at most ``components`` of them.

    Rows whose vector is null or holds null or non-finite entries are left out.  Entries
    are quantised to long (``floor(scale * entry)``); the fit list is each distinct
    vector once, so copies do not shift the components.  ``n`` is its length and
    ``deviation`` the exact sum of (n x - S)^2 over the dimensions (null beyond a long).
    ``identity_error`` is measured: the largest entry of the whitened fit list's
    covariance minus the identity.

    Defined cases: of several vector lengths the one that most distinct vectors have
    counts (ties: the longer), the other rows are left out; empty vectors are left out; a
    component without variance is no component, so equal vectors alone give no rows; so
    does an empty table; repeated rows and null ids are rows of their own; components
    with equal eigenvalues are any basis of their space; other columns are ignored.
    """
    spark = embeddings.sparkSession
    rows = (embeddings.where(usable(F.col("embedding")) & (F.size("embedding") > 0))
            .select(F.col("vec_id").cast("long").alias("vec_id"), quantised(F.col("embedding"), scale).alias("x")))
    distinct = written(rows.select("x").distinct(), "vectors")
    sizes = distinct.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if sizes is None:
        return spark.createDataFrame([], _OUT)
    fit = distinct.where(F.size("x") == sizes["d"])
    w = fit_whitening(fit)
    k = min(components, len(w.values))
    if not k:
        return spark.createDataFrame([], _OUT)
    matrix = w.vectors[:, :k] / np.sqrt(w.values[:k])
    mean = np.array([s / w.n for s in w.sums])
    error = float(np.abs(_covariance(fit, w.n, mean, matrix) - np.eye(k)).max())
    explained = w.values[:k] / w.trace
    return (rows.where(F.size("x") == sizes["d"])
            .mapInArrow(lambda it: _whiten(it, w, matrix, explained, error), _OUT))
