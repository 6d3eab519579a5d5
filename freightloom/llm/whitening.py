"""Whitening of embeddings by pivoted Cholesky and one-sided Jacobi.

An entry c becomes the integer floor(64 c) + 1,000,000, so sums are exact and do not depend on the order in
which tasks finish. A first pass adds up the vectors, a second one the products of their entries, centred at
the rounded mean; the rounding, at most a half an entry, is taken back exactly in whole numbers. What leaves
the tasks is a triangle of d (d + 1) / 2 sums, whatever the number of vectors, and the driver gets their totals.

There the covariance is factored by Cholesky with diagonal pivoting. One-sided Jacobi turns the columns of the
triangular factor themselves until they are orthogonal; the covariance is not formed again. The squared norms
of the turned columns are its eigenvalues, and the columns over their norms its unit eigenvectors. A third
pass measures the covariance of the whitened vectors.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: A pivot below this share of the trace, or an eigenvalue below this share of the largest, counts as zero.
NOTHING = 1e-14
#: Rows a task works on at once.
ROWS = 1 << 11
#: Entries beyond this are refused: their scaled values would not be exact.
LARGEST = 2.0**45

_LONG = (1 << 63) - 1


def pivoted_cholesky(matrix: np.ndarray) -> np.ndarray:
    """``L`` with ``matrix = L L^T``, a column per pivot; its rows stand in the matrix's order.

    The largest remaining diagonal entry is the next pivot; columns end where nothing is left of the trace.
    """
    left = np.diag(matrix).astype(np.float64).copy()
    least = NOTHING * left.sum()
    order = np.arange(len(left))
    columns: list[np.ndarray] = []
    while len(columns) < len(left):
        k = len(columns)
        pivot = k + int(np.argmax(left[order[k:]]))
        if left[order[pivot]] <= least:
            break
        order[k], order[pivot] = order[pivot], order[k]
        own, rest = order[k], order[k + 1 :]
        column = np.zeros(len(left))
        column[own] = math.sqrt(left[own])
        known = np.array(columns).reshape(k, len(left))
        column[rest] = (matrix[rest, own] - known[:, own] @ known[:, rest]) / column[own]
        left[rest] -= column[rest] ** 2
        columns.append(column)
    return np.array(columns).reshape(len(columns), len(left)).T


def jacobi(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of ``factor factor^T``, by turning pairs of columns."""
    columns = np.array(factor.T, order="C")  # a row per column
    count = len(columns)
    for _ in range(sweeps):
        turned = False
        for i in range(count - 1):
            for j in range(i + 1, count):
                a, b = columns[i], columns[j]
                aa, bb, ab = a @ a, b @ b, a @ b
                if abs(ab) <= 1e-15 * math.sqrt(aa * bb):
                    continue
                turned = True
                zeta = (bb - aa) / (2 * ab)
                tangent = math.copysign(1, zeta) / (abs(zeta) + math.hypot(1, zeta))
                cosine = 1 / math.hypot(1, tangent)
                sine = cosine * tangent
                columns[i], columns[j] = cosine * a - sine * b, sine * a + cosine * b
        if not turned:
            break
    norms = np.sqrt((columns**2).sum(1))
    order = np.argsort(-norms, kind="stable")
    order = order[norms[order] ** 2 > NOTHING * (norms.max(initial=0.0) ** 2)]
    return norms[order] ** 2, (columns[order] / norms[order, None]).T


@dataclass(frozen=True)
class Whitening:
    """What turns integer vectors ``x`` into whitened ones."""

    rows: int
    sums: tuple[int, ...]
    #: The mean, rounded; ``x`` less it is small.
    centre: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def whitened(self, small: np.ndarray) -> np.ndarray:
        """Whitened vectors from ``x - centre``."""
        shift = np.array([s - self.rows * int(c) for s, c in zip(self.sums, self.centre)], np.float64) / self.rows
        return (small - shift) @ (self.vectors / np.sqrt(self.values))

    def deviations(self, small: np.ndarray) -> list[int | None]:
        """Sum over dimensions of ``(rows * x - sums) ** 2``, exactly; None where a long does not hold it."""
        back = [s - self.rows * int(c) for s, c in zip(self.sums, self.centre)]
        rough = ((small * float(self.rows) - np.array(back, np.float64)) ** 2).sum(1)
        if rough.max(initial=0.0) < 0.9 * _LONG:  # so every entry and every partial sum fits too
            exact = small * np.int64(self.rows) - np.array(back, np.int64)
            return (exact * exact).sum(1).tolist()
        found = []
        for row, about in zip(small.tolist(), rough):
            total = sum((self.rows * x - b) ** 2 for x, b in zip(row, back)) if about < 1.1 * _LONG else _LONG + 1
            found.append(total if total <= _LONG else None)
        return found


def usable(vector: str) -> F.Column:
    """Whether a vector has entries, none of them null, NaN or infinite."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | F.abs(c).isin(float("inf")))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & ~bad


def _integers(column: pa.Array, dimensions: int) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimensions)
    if (np.abs(values) > LARGEST).any():
        raise ValueError(f"an entry beyond {LARGEST} cannot be scaled exactly")
    return np.floor(SCALE * values).astype(np.int64) + OFFSET


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            yield batch.slice(start, ROWS)


def _totals(rows: DataFrame, size: int, partial: Callable[[Iterator[pa.RecordBatch]], list], kind: str) -> list:
    """Sums over all tasks of the ``size`` numbers that each makes of its batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = partial(batches)
        if sums:
            values = pa.array(sums, pa.decimal128(38, 0) if kind.startswith("decimal") else pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), values], ["place", "value"])

    parts = rows.mapInArrow(run, f"place int, value {kind}")
    found = dict(parts.groupBy("place").agg(F.sum("value").alias("value")).collect())
    return [found.get(k, 0) for k in range(size)]


def _products(small: np.ndarray) -> np.ndarray:
    """``small^T small`` as whole numbers."""
    largest = int(np.abs(small).max(initial=0))
    if largest**2 * len(small) < 1 << 53:
        as_double = small.astype(np.float64)  # sums stay below 2 ** 53, so they are exact and fast
        return (as_double.T @ as_double).astype(np.int64).astype(object)
    return small.astype(object).T @ small.astype(object)


def fit(vectors: DataFrame, vector: str = "embedding", dimensions: int | None = None) -> Whitening | None:
    """Mean, covariance and its eigenvectors over all usable vectors; None if there is none.

    Vectors of another length than most are not usable either (of lengths equally frequent the larger counts).
    """
    rows = vectors.where(usable(vector)).select(F.col(vector).alias("v"))
    if dimensions is None:
        dimensions = _dimensions(rows)
    if not dimensions:
        return None
    d = dimensions
    rows = rows.where(F.size("v") == d)

    def sums(batches: Iterator[pa.RecordBatch]) -> list:
        count, total = 0, np.zeros(d, object)
        for batch in _blocks(batches):
            count += batch.num_rows
            total += _integers(batch.column(0), d).sum(0).astype(object)
        return [Decimal(int(t)) for t in (count, *total)] if count else []

    count, *total = (int(t) for t in _totals(rows, d + 1, sums, "decimal(38,0)"))
    centre = np.array([(2 * t + count) // (2 * count) for t in total], np.int64)
    upper = np.triu_indices(d)

    def products(batches: Iterator[pa.RecordBatch]) -> list:
        count, together = 0, np.zeros((d, d), object)
        for batch in _blocks(batches):
            count += batch.num_rows
            together += _products(_integers(batch.column(0), d) - centre)
        return [Decimal(int(t)) for t in together[upper]] if count else []

    found = [int(t) for t in _totals(rows, len(upper[0]), products, "decimal(38,0)")]
    off = [t - count * int(c) for t, c in zip(total, centre)]
    covariance = np.empty((d, d))
    for value, i, j in zip(found, *upper):
        covariance[i, j] = covariance[j, i] = (count * value - off[i] * off[j]) / count**2
    values, components = jacobi(pivoted_cholesky(covariance))
    return Whitening(count, tuple(total), centre, values, components, float(np.trace(covariance)))


def _dimensions(rows: DataFrame) -> int | None:
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return lengths["d"] if lengths else None


def identity_error(vectors: DataFrame, model: Whitening, vector: str = "embedding") -> float:
    """Largest absolute entry of the whitened vectors' covariance less the identity, over all usable vectors."""
    d, k = len(model.centre), len(model.values)
    rows = vectors.where(usable(vector) & (F.size(vector) == d)).select(F.col(vector).alias("v"))

    def means(batches: Iterator[pa.RecordBatch]) -> list:
        return [float(t) for t in sum((model.whitened(_integers(b.column(0), d) - model.centre).sum(0) for b in _blocks(batches)), np.zeros(k))]

    mean = np.array(_totals(rows, k, means, "double")) / model.rows

    def products(batches: Iterator[pa.RecordBatch]) -> list:
        total = np.zeros((k, k))
        for batch in _blocks(batches):
            off = model.whitened(_integers(batch.column(0), d) - model.centre) - mean
            total += off.T @ off
        return [float(t) for t in total.ravel()]

    covariance = np.array(_totals(rows, k * k, products, "double")).reshape(k, k) / model.rows
    return float(np.abs(covariance - np.eye(k)).max(initial=0.0))


def whitened(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Per usable vector and component: id, ``component, n, deviation, whitened, explained, identity_error``.

    Components are numbered from 1 by falling eigenvalue, at most ``components`` of them; such without any
    variance (more dimensions than vectors, a constant entry) are not components, so vectors that are all
    equal give no rows. A vector that is null or has a null or non-finite entry, an empty one, and one of
    another length than most take no part; zero vectors do. Repeated rows count, and are returned, as often
    as they occur; a null id stays null. ``deviation`` is null where a long does not hold it. An empty table
    gives no rows. Columns other than id and vector are not looked at.
    """
    fields = f"{id_column} {vectors.schema[id_column].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    names = [f.split()[0] for f in fields.split(", ")]
    model = fit(vectors, vector)
    if model is None:
        return vectors.sparkSession.createDataFrame([], fields)
    model = Whitening(model.rows, model.sums, model.centre, model.values[:components], model.vectors[:, :components], model.trace)
    d, k = len(model.centre), len(model.values)
    error = identity_error(vectors, model, vector)
    explained = model.values / model.trace
    shipped = vectors.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shipped.value
        for batch in _blocks(batches):
            small, rows = _integers(batch.column(1), d) - own.centre, batch.num_rows
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(np.repeat(np.arange(rows), k))),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * k, own.rows, np.int64)),
                pa.array(own.deviations(small), pa.int64()).take(pa.array(np.repeat(np.arange(rows), k))),
                pa.array(own.whitened(small).ravel()),
                pa.array(np.tile(explained, rows)),
                pa.array(np.full(rows * k, error)),
            ], names)

    rows = vectors.where(usable(vector) & (F.size(vector) == d)).select(id_column, vector)
    return rows.mapInArrow(run, fields)
