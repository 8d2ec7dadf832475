"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

The centred rows X are only touched by products: each step is one distributed pass that takes
``y = X p`` row by row and returns ``Xᵀ y`` and ``|y|²``. Left vectors are not stored with the rows:
they lie in the range of X, ``u = X w``, so the vector w (one number a dimension) stands for u, and
inner products of left vectors follow from the ``Xᵀ u`` already summed. Both sides are
orthogonalised in full, twice. The driver holds bidiagonal entries and vectors of one number a
dimension; singular values of the small matrix give deviations, its vectors the components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import stored

SCALE = 256
COMPONENTS = 4
#: A singular value this small against the largest is zero.
TINY = 1e-12


class Whitening(NamedTuple):
    n: int
    sums: np.ndarray          # exact, one Python int a dimension
    components: np.ndarray    # one row each, by falling eigenvalue
    eigenvalues: np.ndarray
    trace: float
    identity_error: float | None


def grid_rows(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
              scale: int = SCALE) -> DataFrame:
    """``vec_id, x``: entries as ``floor(scale * c) + 0``, long; rows without a whole vector go.

    A vector that is null, holds null or non-finite entries, or is shorter than the table's
    longest lacks entries and is dropped.
    """
    c = F.col("v").cast("array<double>")
    whole = F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e)
                     & (F.abs(e) < float("inf")))
    kept = rows.select(F.col(id_col).alias("vec_id"), F.col(vec_col).alias("v")).select(
        "vec_id", c.alias("v")).where(F.col("v").isNotNull() & whole)
    longest = kept.agg(F.max(F.size("v"))).first()[0] or 0
    return kept.where(F.size("v") == longest).select(
        "vec_id", F.transform("v", lambda e: F.floor(e * scale).cast("long") + 0).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _summed(fit: DataFrame, dims: int, partial: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all rows of ``partial(block)``, a vector of fixed length, summed by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = partial(_matrix(batch.column(0)).astype(np.float64))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(total)), pa.int32()), pa.array(total)], ["at", "part"])

    rows = fit.select("x").mapInArrow(run, "at int, part double").groupBy("at").agg(
        F.sum("part").alias("part")).collect()
    out = np.zeros(max((r["at"] for r in rows), default=-1) + 1)
    for r in rows:
        out[r["at"]] = r["part"]
    return out


def _orthogonal(v: np.ndarray, basis: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        if basis:
            b = np.array(basis)
            v = v - b.T @ (b @ v)
    return v


def bidiagonalise(fit: DataFrame, mean: np.ndarray, steps: int,
                  seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """``(B, V)`` with ``X V = U B`` for the centred rows X, B upper bidiagonal, V by columns.

    All ``steps`` = number of dimensions find repeated singular values as well. Where the space
    reached from the first vector is used up, a new direction starts with a zero off the diagonal.
    """
    dims, rng = len(mean), np.random.default_rng(seed)

    def product(p: np.ndarray) -> tuple[np.ndarray, float]:
        def partial(block: np.ndarray) -> np.ndarray:
            block = block - mean
            y = block @ p
            return np.append(block.T @ y, y @ y)

        out = _summed(fit, dims, partial)
        return out[:-1], float(out[-1])

    def fresh(basis: list[np.ndarray]) -> np.ndarray:
        v = _orthogonal(rng.standard_normal(dims), basis)
        return v / np.linalg.norm(v)

    # right vectors v; a left vector u = X w is known by w and by z = Xᵀ u
    vs, ws, zs = [fresh([])], [], []
    matrix = np.zeros((steps, steps))
    largest = 0.0
    for j in range(steps):
        v = vs[j]
        # X v less its parts along earlier left vectors, whose lengths are zᵢ · v
        along = [float(z @ v) for z in zs]
        p = v - sum((a * w for a, w in zip(along, ws)), np.zeros(dims))
        g, square = product(p)
        for w, z in zip(ws, zs):  # what rounding left along them: u · y = w · Xᵀy
            rest = float(w @ g)
            p, g, square = p - rest * w, g - rest * z, square - rest * rest
        alpha = np.sqrt(max(square, 0.0))
        largest = max(largest, alpha)
        if j:
            matrix[j - 1, j] = along[j - 1]
        if alpha <= TINY * largest:
            alpha, w, z = 0.0, np.zeros(dims), np.zeros(dims)
        else:
            w, z = p / alpha, g / alpha
        matrix[j, j] = alpha
        ws.append(w)
        zs.append(z)
        if j + 1 < steps:
            rest = _orthogonal(z - alpha * v, vs)
            beta = np.linalg.norm(rest)
            vs.append(rest / beta if beta > TINY * largest else fresh(vs))
    return matrix, np.array(vs).T


def fit_whitening(fit: DataFrame, components: int = COMPONENTS,
                  steps: int | None = None) -> Whitening | None:
    """Components of stored, distinct vectors ``x``; None for an empty list.

    Sums are exact; each covariance centres rows before multiplying and divides by n. ``steps``
    below the number of dimensions is quicker and finds well separated components only.
    """
    n = fit.count()
    if not n:
        return None
    totals = fit.select(F.posexplode("x").alias("d", "e")).groupBy("d").agg(
        F.sum(F.col("e").cast("decimal(38,0)")).alias("s")).collect()
    dims = len(totals)
    sums = np.zeros(dims, object)
    for r in totals:
        sums[r["d"]] = int(r["s"])
    if not dims:
        return Whitening(n, sums, np.zeros((0, 0)), np.zeros(0), 0.0, None)
    mean = np.array([s / n for s in sums], np.float64)
    trace = float(_summed(fit, dims, lambda b: ((b - mean) ** 2).sum(axis=0)).sum()) / n
    steps = min(steps or dims, dims)
    matrix, right = bidiagonalise(fit, mean, steps)
    _, deviations, turn = np.linalg.svd(matrix)
    top = min(components, steps)
    found = (right @ turn.T).T[:top]
    found /= np.linalg.norm(found, axis=1, keepdims=True)
    eigenvalues = deviations[:top] ** 2 / n
    eigenvalues[deviations[:top] <= TINY * deviations[0]] = 0.0

    held = eigenvalues > 0
    error = None
    if held.any():
        to = found[held] / np.sqrt(eigenvalues[held])[:, None]
        k = len(to)
        centre = _summed(fit, dims, lambda b: ((b - mean) @ to.T).sum(axis=0)) / n

        def partial(block: np.ndarray) -> np.ndarray:
            white = (block - mean) @ to.T - centre
            return (white.T @ white).ravel()

        error = float(np.abs(_summed(fit, dims, partial).reshape(k, k) / n - np.eye(k)).max())
    return Whitening(n, sums, found, eigenvalues, trace, error)


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Sum over dimensions of ``(n x - S)²``, exact; null where it passes a long."""
    top = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) * n + max(map(abs, sums), default=0)
    if top * top * max(1, x.shape[1]) < 1 << 63:
        return ((x * n - sums.astype(np.int64)) ** 2).sum(axis=1).tolist()
    exact = [sum((n * e - s) ** 2 for e, s in zip(row, sums)) for row in x.tolist()]
    return [e if e < 1 << 63 else None for e in exact]


def whiten(rows: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id",
           vec_col: str = "embedding", scale: int = SCALE, steps: int | None = None) -> DataFrame:
    """One row per whole vector and component: ``vec_id, component, n, deviation, whitened,
    explained, identity_error``.

    The fit list holds each distinct vector of the grid once. Components are numbered from 1 by
    falling eigenvalue, at most as many as there are dimensions. A component without variance has
    null ``whitened``; ``explained`` is null if nothing varies, ``identity_error`` is over
    components with variance. Vectors that lack entries are dropped (``grid_rows``); an empty
    table, or one with empty vectors only, gives no rows. Repeated rows, ties and null ids are
    rows like any other; other columns are not read.
    """
    grid = stored(grid_rows(rows, id_col, vec_col, scale), "grid")
    fit = stored(grid.select("x").distinct(), "fit")
    model = fit_whitening(fit, components, steps)
    kind = grid.schema["vec_id"].dataType.simpleString()
    schema = (f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, "
              "explained double, identity_error double")
    if model is None or not len(model.components):
        return rows.sparkSession.createDataFrame([], schema)
    mean = np.array([s / model.n for s in model.sums], np.float64)
    held = model.eigenvalues > 0
    to = model.components / np.sqrt(np.where(held, model.eigenvalues, 1.0))[:, None]
    explained = [float(e / model.trace) if model.trace else None for e in model.eigenvalues]
    k = len(to)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows_in = batch.num_rows
            if not rows_in:
                continue
            x = _matrix(batch.column(1))
            white = (x - mean) @ to.T
            numbers = np.repeat(np.arange(rows_in), k)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(numbers)),
                pa.array(np.tile(np.arange(1, k + 1), rows_in), pa.int32()),
                pa.array(np.full(rows_in * k, model.n, np.int64)),
                pa.array(_deviations(x, model.n, model.sums), pa.int64()).take(pa.array(numbers)),
                pa.array(white.ravel(), mask=np.tile(~held, rows_in)),
                pa.array(explained * rows_in, pa.float64()),
                pa.array([model.identity_error] * (rows_in * k), pa.float64()),
            ], ["vec_id", "component", "n", "deviation", "whitened", "explained",
                "identity_error"])

    return grid.mapInArrow(run, schema)
