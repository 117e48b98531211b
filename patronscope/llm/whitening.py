"""Whitening of embeddings by spectral divide and conquer.

Entries become integers (``floor(SCALE * c) + OFFSET``), so that counts, sums and deviations are exact. The covariance is taken over
the fit list, which holds each distinct vector once, and centred before multiplying. Its spectrum is found by divide and conquer: the
orthogonal polar factor of the covariance shifted by a value inside its spectrum gives the projector on the
components above that value; orthonormal bases of the projector's range and complement split the problem in two, and so on
down to single components. The polar factor comes from QDWH iterations, which use only QR, Cholesky and products. Parts that
hold none of the wanted components are not split further. The components travel to every task.

Tasks send sums and moment matrices only; the driver holds matrices of the vectors' dimension, which is the bound (``MAX_DIMENSION``).

Defined cases: rows whose vector is null, is of another length than most vectors (the shorter on a tie), or holds a null, a non-finite entry
or one of 2**40 or more are dropped; repeated rows count once in the fit list and stay in the result; a component without variance has whitened
value 0 and explains 0; a deviation beyond 64 bits is null; an empty table gives an empty result; input columns pass through
inside ``row``.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType

from patronscope.llm.common import schema_with
from patronscope.session import settle

SCALE = 64
OFFSET = 1_000_000
LARGEST = float(1 << 40)
MAX_DIMENSION = 8192
EPS = np.finfo(float).eps
#: The largest value that a deviation is summed to exactly.
EXACT = 9.2e18


# --- spectrum ---------------------------------------------------------------------------


def polar_factor(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a square matrix by QDWH: dynamically weighted Halley steps, by QR
    while the matrix is ill-conditioned and by Cholesky afterwards."""
    n = len(a)
    eye = np.eye(n)
    x = a / max(np.sqrt(np.linalg.norm(a, 1) * np.linalg.norm(a, np.inf)), np.finfo(float).tiny)
    r = np.linalg.qr(x, mode="r")
    smallest = np.abs(np.diag(r)).min()
    if smallest > EPS:
        low = min(1.0, max(EPS, 0.9 / (np.linalg.norm(np.linalg.solve(r, eye), 1) * np.sqrt(n))))
    else:
        low = EPS
    for _ in range(30):
        gamma = (4 * (1 - low**2) / low**4) ** (1 / 3)
        root = np.sqrt(1 + gamma)
        alpha = root + 0.5 * np.sqrt(max(0.0, 8 - 4 * gamma + 8 * (2 - low**2) / (low**2 * root)))
        beta = (alpha - 1) ** 2 / 4
        c = alpha + beta - 1
        if c > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(c) * x, eye]))
            new = beta / c * x + (alpha - beta / c) / np.sqrt(c) * (q[:n] @ q[n:].T)
        else:
            w = np.linalg.cholesky(eye + c * (x.T @ x))
            new = beta / c * x + (alpha - beta / c) * np.linalg.solve(w.T, np.linalg.solve(w, x.T)).T
        moved = np.linalg.norm(new - x)
        x = new
        low = min(1.0, low * (alpha + beta * low**2) / (1 + c * low**2))
        if moved <= (10 * EPS) ** (1 / 3) and abs(1 - low) < 1e-8:
            # one Newton-Schulz step takes what is left to rounding
            return x @ (1.5 * eye - 0.5 * (x.T @ x))
    return x


def split_spectrum(a: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces above and below a value inside the spectrum of ``a``.

    None if ``a`` is a multiple of the identity up to rounding. A shift too near an eigenvalue gives no projector; the next one is tried.
    """
    n = len(a)
    diagonal = np.sort(np.diag(a))
    if np.linalg.norm(a - np.diag(np.diag(a))) <= 4 * EPS * n * scale and diagonal[-1] - diagonal[0] <= 4 * EPS * n * scale:
        return None
    start = np.random.default_rng(n).standard_normal((n, n))
    middle = (diagonal[0] + diagonal[-1]) / 2
    shifts = [np.median(diagonal), diagonal.mean(), middle, *np.quantile(diagonal, [0.25, 0.75, 0.4, 0.6])]
    spread = np.linalg.norm(a - middle * np.eye(n))
    shifts += [middle + spread * s for s in (1e-3, -1e-3, 0.03, -0.03, 0.1, -0.1, 0.3, -0.3, 1e-6, -1e-6)]
    best = None
    for shift in shifts:
        projector = (polar_factor(a - shift * np.eye(n)) + np.eye(n)) / 2
        projector = (projector + projector.T) / 2
        k = int(round(np.trace(projector)))
        if not 0 < k < n or not np.isfinite(projector).all():
            continue
        basis, _ = np.linalg.qr(projector @ start)
        basis, _ = np.linalg.qr(np.hstack([projector @ basis[:, :k], basis[:, k:] - projector @ basis[:, k:]]))
        lost = np.linalg.norm(basis[:, k:].T @ a @ basis[:, :k])
        if best is None or lost < best[0]:
            best = lost, basis[:, :k], basis[:, k:]
        if lost <= 8 * EPS * n * scale:
            break
    return best and best[1:]


def leading_components(a: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``top`` largest eigenvalues of a symmetric matrix, falling, and unit eigenvectors as columns."""
    a = (a + a.T) / 2
    scale = np.linalg.norm(a)
    found: list[tuple[float, np.ndarray]] = []
    parts = [(np.eye(len(a)), a, top)]
    while parts:
        basis, inner, wanted = parts.pop()
        halves = split_spectrum(inner, scale) if len(inner) > 1 else None
        if halves is None:
            found += [(inner[i, i], basis[:, i]) for i in range(len(inner))]
            continue
        for half, need in zip(halves, (wanted, wanted - halves[0].shape[1]), strict=True):
            if need > 0:
                own = half.T @ inner @ half
                parts.append((basis @ half, (own + own.T) / 2, need))
    vectors = np.column_stack([v for _, v in sorted(found, key=lambda p: -p[0])])
    vectors = _polished(a, vectors, scale)
    values = np.einsum("ij,ij->j", vectors, a @ vectors)
    order = np.argsort(-values, kind="stable")[:top]
    return values[order], vectors[:, order]


def _polished(a: np.ndarray, vectors: np.ndarray, scale: float) -> np.ndarray:
    """One step of iterative refinement of the found vectors among themselves: it takes rounding of the recursion out."""
    overlap = np.eye(vectors.shape[1]) - vectors.T @ vectors
    inner = vectors.T @ a @ vectors
    values = np.diag(inner) / (1 - np.diag(overlap))
    gap = values[None, :] - values[:, None]
    wide = np.abs(gap) > 1e-6 * scale
    step = np.where(wide, (inner + overlap * values[None, :]) / np.where(wide, gap, 1), overlap / 2)
    np.fill_diagonal(step, np.diag(overlap) / 2)
    return vectors + vectors @ step


# --- Spark ------------------------------------------------------------------------------


class Whitening(NamedTuple):
    """Size and sums of the fit list (sums of ``x - pivot``), components as columns, their eigenvalues, and the quality of the fit."""

    n: int
    pivot: np.ndarray
    sums: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: np.ndarray
    identity_error: float


def integer_rows(rows: DataFrame, vector: str) -> DataFrame:
    """(row: the other columns, x: array of long) of the rows with a usable vector."""
    v = rows[f"`{vector}`"]
    usable = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(LARGEST)))
    kept = [rows[f"`{c}`"] for c in rows.columns if c != vector] or [F.lit(None).alias("none")]
    x = F.transform(v, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + F.lit(OFFSET).cast("long"))
    whole = rows.select(F.struct(*kept).alias("row"), F.when(usable & (F.size(v) > 0), x).alias("x")).where("x is not null")
    most = whole.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").limit(1)
    found = most.first()
    return whole.where(F.size("x") == (found["d"] if found else 0))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)


def _centred(x: np.ndarray, sums: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``n * x - sums`` as integers, and divided by n; where the integers do not fit, only the second is right."""
    gap, rough = n * x - sums, n * x.astype(float) - sums
    return gap, np.where(np.abs(rough) < 4e18, gap, rough) / float(n)


def _totals(partial: DataFrame) -> np.ndarray:
    """Sums by position over rows (v array): one number for each position comes to the driver."""
    summed = partial.select(F.posexplode("v").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v")).toArrow()
    order = np.argsort(summed.column("at").to_numpy())
    return summed.column("v").to_numpy()[order]


def _moments(fit: DataFrame, pivot: np.ndarray, sums: np.ndarray, n: int, project: np.ndarray | None = None) -> np.ndarray:
    """The covariance of the centred vectors, or of their projections; every task sums its own matrix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                _, centred = _centred(_matrix(batch) - pivot, sums, n)
                centred = centred if project is None else centred @ project
                total = centred.T @ centred + (0 if total is None else total)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.ravel()])], names=["v"])

    flat = _totals(fit.mapInArrow(run, "v array<double>")) / n
    size = int(round(np.sqrt(len(flat))))
    return flat.reshape(size, size)


def fit_whitening(vectors: DataFrame, components: int = 16) -> Whitening | None:
    """The whitening of ``vectors`` (x array of long, all of one length); None if there is none."""
    fit = settle(vectors.groupBy("x").agg(F.count(F.lit(1)).alias("copies")).select("x"), "fit")
    first = fit.limit(1).toArrow()
    if not first.num_rows:
        return None
    pivot = np.array(first.column("x")[0].as_py(), np.int64)  # any vector will do: differences stay small
    if len(pivot) > MAX_DIMENSION:
        raise ValueError(f"vectors have at most {MAX_DIMENSION} entries")

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(len(pivot) + 1, np.int64)
        for batch in batches:
            if batch.num_rows:
                sums[:-1] += (_matrix(batch) - pivot).sum(axis=0)
                sums[-1] += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array([sums])], names=["v"])

    *sums, n = _totals(fit.mapInArrow(total, "v array<long>")).tolist()
    sums = np.array(sums, np.int64)
    covariance = _moments(fit, pivot, sums, n)
    covariance = (covariance + covariance.T) / 2
    trace = float(np.trace(covariance))
    values, vectors_ = leading_components(covariance, min(components, len(pivot)))
    varied = values > max(EPS * len(pivot) * trace, 0.0)
    values = np.where(varied, values, 0.0)
    vectors_ = vectors_ * np.where(vectors_.sum(axis=0) < 0, -1.0, 1.0)
    error = 0.0
    if varied.any():
        white = _moments(fit, pivot, sums, n, vectors_[:, varied] / np.sqrt(values[varied]))
        error = float(np.abs(white - np.eye(int(varied.sum()))).max())
    return Whitening(n, pivot, sums, vectors_, values, values / trace if trace else values, error)


def whiten(rows: DataFrame, model: Whitening) -> DataFrame:
    """(row, deviation, whitened: array by component) of integer rows."""
    n, pivot, sums, vectors, values = model[:5]
    root = np.sqrt(values)
    project = np.where(root > 0, vectors / np.where(root > 0, root, 1), 0.0)
    schema = schema_with(rows.schema["row"].dataType, ("deviation", LongType()), ("whitened", ArrayType(DoubleType())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch) - pivot if batch.num_rows else np.zeros((0, len(pivot)), np.int64)
            gap, centred = _centred(x, sums, n)
            large = ((n * centred) ** 2).sum(axis=1) > EXACT * 0.99
            exact = (gap * gap).sum(axis=1)
            deviation = [None if big and (d := _exact(n, row, sums)) > EXACT else d if big else e
                         for big, row, e in zip(large.tolist(), x, exact.tolist())] if large.any() else exact
            white = centred @ project
            offsets = np.arange(len(x) + 1, dtype=np.int32) * white.shape[1]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(deviation, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(white.ravel()))],
                names=["row", "deviation", "whitened"],
            )

    return rows.mapInArrow(run, schema)


def _exact(n: int, x: np.ndarray, sums: np.ndarray) -> int:
    return sum((n * a - s) ** 2 for a, s in zip(x.tolist(), sums.tolist()))


def whitened_rows(rows: DataFrame, vector: str = "embedding", components: int = 16) -> tuple[DataFrame, Whitening | None]:
    """(row, deviation, whitened) for each usable row of ``rows``, and the model fitted on its distinct vectors."""
    usable = integer_rows(rows, vector)
    model = fit_whitening(usable.select("x"), components)
    if model is None:
        empty = schema_with(usable.schema["row"].dataType, ("deviation", LongType()), ("whitened", ArrayType(DoubleType())))
        return rows.sparkSession.createDataFrame([], empty), None
    return whiten(usable, model), model
