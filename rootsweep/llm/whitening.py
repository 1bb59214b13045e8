"""Operator 13: embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

Vectors become integers, ``floor(scale * component)``; the fit list holds each distinct
integer vector once, written as blocks of rows. With A the centred fit list, every step
multiplies it by a vector and its transpose by the outcome: one distributed pass whose
tasks send back one sum per dimension. The left vectors u = A p are never moved: the
driver keeps p and Aᵀu (as long as the vectors), from which it orthogonalises new left
and right vectors against all earlier ones. The singular values and right vectors of
the small bidiagonal matrix are the deviations and components.

A chain that breaks off goes on with a random direction orthogonal to all earlier ones.
One that finds its leading components before half of the possible steps is followed by
a chain in the orthogonal complement, so that a repeated eigenvalue is not missed.

Cases: vectors that are null, empty, of another than the most frequent length, or that
hold null, non-finite or too large components (2**62 after scaling) are left out;
repeated rows are one fit vector and each a row of the result; components without
variance are not returned, so an empty table, or one with a single distinct vector,
gives no rows; a null id is kept; a deviation beyond 64 bits is null; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rootsweep.llm.common import stored
from rootsweep.llm.vectors import common_length, exact, from_bytes, points, to_bytes

SCALE, COMPONENTS = 256, 4
#: Bytes of fit vectors in a block.
BLOCK_BYTES = 1 << 20
#: A singular value below this share of the largest counts as zero.
NO_VARIANCE = 1e-10

Products = Callable[[np.ndarray], tuple[float, np.ndarray]]


@dataclass(frozen=True)
class Whitening:
    """A fitted transform: n and sums of the fit list, and per component its direction
    (rows), variance and share of the total variance."""

    n: int
    sums: tuple[int, ...]
    directions: np.ndarray
    variances: np.ndarray
    explained: np.ndarray
    identity_error: float

    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def project(self) -> np.ndarray:
        """Centred vectors times this matrix are whitened."""
        return (self.directions / np.sqrt(self.variances)[:, None]).T


# ---- the fit list ------------------------------------------------------------------
def _fit_list(rows: DataFrame, length: int) -> DataFrame:
    """Distinct vectors in blocks: (rows, x)."""
    most = max(1, BLOCK_BYTES // (8 * length))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(0).to_pylist()
            parts = [from_bytes(x[i:i + most], length) for i in range(0, len(x), most)]
            raw = [to_bytes(p.reshape(1, -1))[0].as_py() for p in parts]
            yield pa.RecordBatch.from_arrays([pa.array([len(p) for p in parts], pa.int32()), pa.array(raw, pa.binary())], ["rows", "x"])

    return stored(rows.select("x").distinct().mapInArrow(run, "rows int, x binary"), "whitening-fit")


def _matrices(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for rows, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            yield from_bytes([raw], rows * length).reshape(rows, length)


def _size_and_sums(fit: DataFrame, length: int) -> tuple[int, tuple[int, ...]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * (length + 1)
        for x in _matrices(batches, length):
            wide = int(np.abs(x).max()) * len(x) >= 1 << 62
            for i, s in enumerate((x.astype(object) if wide else x).sum(0)):
                total[i] += int(s)
            total[length] += len(x)
        yield pa.RecordBatch.from_arrays([pa.array(range(length + 1), pa.int32()), exact(total)], ["i", "v"])

    got = fit.mapInArrow(run, "i int, v decimal(38,0)").groupBy("i").agg(F.sum("v").alias("v")).collect()
    total = {r["i"]: int(r["v"]) for r in got}
    return total.get(length, 0), tuple(total.get(i, 0) for i in range(length))


def _summed(fit: DataFrame, mean: np.ndarray, work: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """Sum over all blocks of ``work(centred rows)``, ``width`` numbers: one pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width)
        for x in _matrices(batches, len(mean)):
            total += work(x - mean)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(total)], ["i", "v"])

    out = np.zeros(width)
    for r in fit.mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():
        out[r["i"]] = r["v"]
    return out


# ---- bidiagonalisation -----------------------------------------------------------------
def _orthogonal(z: np.ndarray, *bases: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for base in bases:
            if base:
                m = np.array(base)
                z = z - (m @ z) @ m
    return z


def chain(products: Products, length: int, limit: int, k: int, locked: list[np.ndarray],
          rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray, bool]:
    """Leading ``k`` singular values and right vectors orthogonal to ``locked``, and
    whether all ``limit`` steps were made. ``products(q)`` gives (|Aq|², AᵀAq)."""
    right: list[np.ndarray] = []
    left: list[np.ndarray] = []  # p, for u = A p
    back: list[np.ndarray] = []  # Aᵀu
    alphas: list[float] = []
    betas: list[float] = []
    top, broke = 0.0, False
    v = _orthogonal(rng.standard_normal(length), locked)
    v /= np.linalg.norm(v)
    while True:
        q = v - betas[-1] * left[-1] if betas else v
        square, g = products(q)
        for _ in range(2):
            if left:
                h = np.array(left) @ g
                q, g, square = q - h @ np.array(left), g - h @ np.array(back), square - h @ h
        alpha = float(np.sqrt(max(0.0, square)))
        top = max(top, alpha)
        if alpha <= 1e-12 * top:
            alpha, q, g = 0.0, np.zeros(length), np.zeros(length)
        else:
            q, g = q / alpha, g / alpha
        right.append(v)
        left.append(q)
        back.append(g)
        alphas.append(alpha)
        z = _orthogonal(g - alpha * v, locked, right)
        beta = float(np.linalg.norm(z))
        u, s, vt = np.linalg.svd(np.diag(alphas) + np.diag(betas, 1))
        done = len(right) >= limit
        early = not broke and len(right) >= k and 2 * len(right) <= limit and (beta * np.abs(u[-1, :k]) <= 1e-14 * s[0]).all()
        if done or (early and beta > 0):
            return s[:k], vt[:k] @ np.array(right), done
        if beta <= 1e-14 * top:
            broke, beta = True, 0.0
            z = _orthogonal(rng.standard_normal(length), locked, right)
        betas.append(beta)
        v = z / np.linalg.norm(z)


def leading(products: Products, length: int, limit: int, k: int, seed: int = 13) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest singular values of A, falling, and their right vectors (rows)."""
    rng = np.random.default_rng(seed)
    if limit <= 0:
        return np.zeros(0), np.zeros((0, length))
    values, vectors, whole = chain(products, length, limit, min(k, limit), [], rng)
    while not whole and len(values) < limit:
        more, found, _ = chain(products, length, limit - len(values), 1, list(vectors), rng)
        values, vectors = np.append(values, more), np.vstack([vectors, found])
        order = np.argsort(-values, kind="stable")
        values, vectors = values[order], vectors[order]
        if more[0] <= values[k - 1] and order[-1] == len(values) - 1:
            break
    return values[:k], vectors[:k]


# ---- fit and transform -------------------------------------------------------------------
def fit_whitening(rows: DataFrame, length: int, components: int = COMPONENTS) -> Whitening | None:
    """Fit on the distinct vectors of ``rows`` (column x); None without a vector."""
    fit = _fit_list(rows, length)
    n, sums = _size_and_sums(fit, length)
    if n == 0:
        return None
    mean = np.array([s / n for s in sums])

    def products(q: np.ndarray) -> tuple[float, np.ndarray]:
        def both(x: np.ndarray) -> np.ndarray:
            w = x @ q
            return np.append(x.T @ w, w @ w)

        got = _summed(fit, mean, both, length + 1)
        return float(got[-1]), got[:-1]

    values, vectors = leading(products, length, min(length, n - 1), components)
    kept = values > NO_VARIANCE * (values[0] if len(values) else 0.0)
    values, vectors = values[kept], vectors[kept]
    k = len(values)
    if k == 0:
        return Whitening(n, sums, vectors, values, values, 0.0)
    variances = values * values / n
    project = (vectors / np.sqrt(variances)[:, None]).T
    first = _summed(fit, mean, lambda x: np.append((x @ project).sum(0), np.square(x).sum()), k + 1)
    middle = first[:k] / n
    second = _summed(fit, mean, lambda x: ((y := x @ project - middle).T @ y).ravel(), k * k)
    error = float(np.abs(second.reshape(k, k) / n - np.eye(k)).max())
    return Whitening(n, sums, vectors, variances, variances / (first[k] / n), error)


def _deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """Sum over dimensions of (n x - S)², exact; null beyond 64 bits."""
    most = n * int(np.abs(x).max(initial=0)) + max((abs(s) for s in sums), default=0)
    if most * most * max(1, x.shape[1]) < 1 << 63:
        return np.square(n * x - np.array(sums, np.int64)).sum(1).tolist()
    wide = np.square(n * x.astype(object) - np.array(sums, object)).sum(1)
    return [int(v) if v < 1 << 63 else None for v in wide]


RESULT = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE,
           components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: (vec_id, component, n, deviation,
    whitened, explained, identity_error)."""
    schema = f"{vec_id} {dict(vectors.dtypes)[vec_id]}, {RESULT}"
    length = common_length(vectors, vector)
    if length == 0:
        return vectors.sparkSession.createDataFrame([], schema)
    rows = stored(points(vectors, vector, length, scale, id=vec_id), "whitening-rows")
    w = fit_whitening(rows, length, components)
    if w is None or not len(w.variances):
        return vectors.sparkSession.createDataFrame([], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, project, k = w.mean(), w.project(), len(w.variances)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = from_bytes(batch.column(1).to_pylist(), length)
            m, of = len(x), np.repeat(np.arange(len(x)), k)
            deviation = pa.array(_deviations(x, w.n, w.sums), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(of)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                 pa.array(np.full(m * k, w.n)), deviation.take(pa.array(of)), pa.array(((x - mean) @ project).ravel()),
                 pa.array(np.tile(w.explained, m)), pa.array(np.full(m * k, w.identity_error))],
                [vec_id, *[c.split()[0] for c in RESULT.split(", ")]])

    return rows.mapInArrow(run, schema)
