"""Whitened vectors with exact covariances by polarisation.

A component c becomes the whole number x = floor(64 * c) + 1000000.  The fit list holds each distinct x vector once.
One pass sums it per dimension; a second pass subtracts the whole part of each mean and adds up, exactly, the squares of
every centred dimension and of every sum of two centred dimensions.  As Var(a + b) - Var(a) - Var(b) = 2 Cov(a, b), the
differences of these sums are the cross-covariances; the part of a mean behind the point is corrected in whole numbers
too, so every covariance is rounded once, when it becomes a double.  The matrix is bounded by the square of the
dimension, not by rows: the driver assembles it and takes its eigenvectors.

Rows without a vector, or with null or non-finite components, take no part.  Shorter vectors count
as padded with zeros to the longest.  A null ``vec_id`` stays null; repeated rows and ids each give their rows, and
repeated vectors count once in the fit.  Directions without spread (an eigenvalue of rounding size) cannot be whitened
and give no rows: an empty table, a single vector or vectors that are all equal give none at all.  Equal eigenvalues
leave the choice among their vectors to the solver.  Columns other than ``vec_id`` and ``embedding`` are not read.  A
component so large that x or ``deviation`` does not fit a long raises an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import stored
from .words import slices

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
#: Rows worked on at once in a task.
ROWS = 4096
#: Beyond this distance from the mean, a squared deviation cannot fit a long.
FARTHEST = 1 << 31
_LOW = (1 << 32) - 1


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """``vec_id, x`` of the usable rows, all of the same length."""
    c = F.col("embedding")
    finite = F.forall(c, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    x = F.transform(c, lambda e: F.floor(e.cast("double") * SCALE).cast("long") + F.lit(SHIFT).cast("long"))
    usable = embeddings.filter(c.isNotNull() & finite)
    width = usable.agg(F.max(F.size("embedding"))).first()[0] or 0
    missing = F.array_repeat(F.lit(SHIFT).cast("long"), F.lit(width) - F.size("embedding"))
    return usable.select(F.col("vec_id").cast("long").alias("vec_id"), F.concat(x, missing).alias("x"))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("x")
    return column.flatten().to_numpy().reshape(len(column), -1)


def _limbs(position: np.ndarray, total: np.ndarray) -> pa.RecordBatch:
    """Whole numbers of any size as two longs each, which add up without loss."""
    high = np.array([int(v) >> 32 for v in total], np.int64)
    low = np.array([int(v) & _LOW for v in total], np.int64)
    return pa.RecordBatch.from_pydict({"position": position.astype(np.int64), "high": high, "low": low})


def _add_up(partial: DataFrame) -> dict[int, int]:
    """Sums by position; one row per dimension or pair of dimensions reaches the driver."""
    exact = partial.groupBy("position").agg(
        F.sum(F.col("high").cast("decimal(20,0)")).alias("high"), F.sum(F.col("low").cast("decimal(20,0)")).alias("low")
    )
    return {r["position"]: (int(r["high"]) << 32) + int(r["low"]) for r in exact.collect()}


_PARTIAL = "position long, high long, low long"


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (at position -1) and sums per dimension of a task."""
    count, total = 0, None
    for batch in slices(batches, ROWS):
        x = _matrix(batch)
        high, low = (x >> 32).sum(0), (x & _LOW).sum(0)
        part = high.astype(object) * (1 << 32) + low
        count, total = count + len(x), part if total is None else total + part
    if count:
        yield _limbs(np.arange(-1, len(total)), np.array([count, *total], object))


def _squares(centre: list[int]):
    """Sums of squares of a task: each dimension, then each pair (i, j) with i < j."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        middle, total = np.array(centre, np.int64), None
        for batch in slices(batches, ROWS):
            y = _centred(_matrix(batch), middle)
            if np.abs(y).max(initial=0) >= 1 << 22:
                y = y.astype(object)
            parts = [(y**2).sum(0)]
            for i in range(y.shape[1] - 1):
                parts.append(((y[:, i : i + 1] + y[:, i + 1 :]) ** 2).sum(0))
            part = np.concatenate(parts).astype(object)
            total = part if total is None else total + part
        if total is not None:
            yield _limbs(np.arange(len(total)), total)

    return run


def _centred(x: np.ndarray, middle: np.ndarray) -> np.ndarray:
    # Compared before subtracting, which could wrap around.
    if (np.abs(x.astype(float) - middle) >= FARTHEST).any():
        raise OverflowError("a vector is too far from the mean for its squared deviation to fit a long")
    return x - middle


def covariance(fit: DataFrame) -> tuple[int, list[int], list[int], np.ndarray]:
    """Rows, whole part and remainder (over rows) of the means, and covariances of the vectors ``x`` of ``fit``."""
    sums = _add_up(fit.mapInArrow(_sums, _PARTIAL))
    n = sums.pop(-1, 0)
    width = len(sums)
    centre = [sums[d] // n for d in range(width)]
    rest = [sums[d] % n for d in range(width)]
    matrix = np.zeros((width, width))
    if width:
        q = _add_up(fit.mapInArrow(_squares(centre), _PARTIAL))
        pair = width
        for i in range(width):
            matrix[i, i] = (n * q[i] - rest[i] ** 2) / n**2
            for j in range(i + 1, width):
                # n * sum of (yi + yj)^2 - (ri + rj)^2 and so on are the variances, times n^2.
                both = n * q[pair] - (rest[i] + rest[j]) ** 2
                apart = n * (q[i] + q[j]) - rest[i] ** 2 - rest[j] ** 2
                matrix[i, j] = matrix[j, i] = (both - apart) / (2 * n**2)
                pair += 1
    return n, centre, rest, matrix


def components(matrix: np.ndarray, at_most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues above rounding size, falling, and their unit vectors (rows); the largest entry is positive."""
    if not len(matrix):
        return np.zeros(0), np.zeros((0, 0))
    values, vectors = np.linalg.eigh(matrix)
    values, vectors = values[::-1], vectors.T[::-1]
    real = np.flatnonzero(values > values[0] * len(matrix) * np.finfo(float).eps)[:at_most]
    vectors = vectors[real]
    largest = np.take_along_axis(vectors, np.abs(vectors).argmax(1)[:, None], 1)
    return values[real], vectors * np.where(largest < 0, -1.0, 1.0)


def _project(n: int, centre: list[int], rest: list[int], values: np.ndarray, vectors: np.ndarray):
    middle, offset, scaled = np.array(centre, np.int64), np.array(rest) / n, (vectors / np.sqrt(values)[:, None]).T

    def run(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        y = _centred(x, middle)
        return y, (y - offset) @ scaled

    return run


def _products(project):
    """Sums of whitened values and of their products in a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in slices(batches, ROWS):
            _, w = project(_matrix(batch))
            w = np.column_stack([w, np.ones(len(w))])
            total = total + w.T @ w
        if isinstance(total, np.ndarray):
            yield pa.RecordBatch.from_pydict({"position": np.arange(total.size), "value": total.ravel()})

    return run


def identity_error(fit: DataFrame, project, count: int) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity, measured on its values."""
    sums = fit.mapInArrow(_products(project), "position long, value double").groupBy("position").agg(F.sum("value"))
    full = np.zeros((count + 1) ** 2)
    for position, value in sums.collect():
        full[position] = value
    full = full.reshape(count + 1, count + 1) / full[-1]
    measured = full[:count, :count] - np.outer(full[:count, count], full[:count, count])
    return float(np.abs(measured - np.eye(count)).max(initial=0.0))


def _rows(project, n: int, rest: list[int], share: np.ndarray, error: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, k = np.array(rest, np.int64), len(share)
        for batch in slices(batches, ROWS):
            y, w = project(_matrix(batch))
            far = n * float(np.abs(y).max(initial=0) + 1)
            small = far**2 * len(r) < 2**62
            z = n * y - r if small else n * y.astype(object) - np.array(rest, object)
            deviation = (z**2).sum(1)
            if not small and max(deviation) >= 1 << 63:
                raise OverflowError("a squared deviation does not fit a long")
            rows = len(y)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(np.repeat(np.arange(rows), k)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, n, np.int64)),
                    pa.array(np.repeat(deviation.astype(np.int64), k)),
                    pa.array(w.ravel()),
                    pa.array(np.tile(share, rows)),
                    pa.array(np.full(rows * k, error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return run


RESULT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def whitened(embeddings: DataFrame, at_most: int = COMPONENTS) -> DataFrame:
    """Whitened components of every usable vector of ``embeddings`` (``vec_id, embedding``), falling by spread.

    ``vec_id, component, n, deviation, whitened, explained, identity_error``: ``n`` vectors fitted; ``deviation`` the
    sum of (n * x - S)^2, exact; ``explained`` the component's share of the trace.
    """
    rows = stored(whole_vectors(embeddings), "whole-vectors")
    fit = stored(rows.select("x").distinct(), "fit-list")
    n, centre, rest, matrix = covariance(fit)
    values, vectors = components(matrix, at_most)
    if not len(values):
        return rows.sparkSession.createDataFrame([], RESULT)
    project = _project(n, centre, rest, values, vectors)
    error = identity_error(fit, project, len(values))
    return rows.mapInArrow(_rows(project, n, rest, values / np.trace(matrix), error), RESULT)
