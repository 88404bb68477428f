"""Solvers that pass over packed rows: Newton steps for logistic models, quasi-Newton steps for networks.

Rows are packed once into blocks of numbers, kept by the executors.  A pass is one job: its tasks add up a few sums of
fixed size over their blocks, whatever the rows, and the driver takes a step from the total.  Functions that tasks run are
nested: they travel with the job, so executors need not have this package.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of a block (features, label, weight: 1.8 MB at 53 features), and rows worked on at a time within it.
BLOCK_ROWS = 4096
CHUNK_ROWS = 1024
#: Numbers of a network: 32 bits, as is usual for networks; a gradient differs by about 2e-7 of its length.
NETWORK_KIND = "<f4"
#: Inner sums of a block: (features, label, weight) -> one flat array.
Sums = Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray]


@contextmanager
def packed(df: DataFrame, kind: str = "<f8") -> Iterator[RDD]:
    """Blocks (rows, values) of rows with ``features``, ``label`` and ``weight``, kept while in use as numbers of ``kind``."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                rows = part.column("x").flatten().to_numpy().reshape(part.num_rows, -1)
                yield pa.RecordBatch.from_pydict({
                    "n": pa.array([part.num_rows], pa.int64()), "values": pa.array([np.ascontiguousarray(rows, kind).tobytes()], pa.binary()),
                })

    numbers = F.concat(vector_to_array(F.col("features")), F.array(F.col("label").cast("double"), F.col("weight").cast("double")))
    made = df.select(numbers.alias("x")).mapInArrow(pack, "n long, values binary")
    # Pickled blocks go to the tasks as they are kept; kept as table rows they took longer than the sums of a network.
    blocks = made.rdd.map(lambda row: (row["n"], bytes(row["values"]))).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield blocks
    finally:
        blocks.unpersist()


def total(blocks: RDD, sums: Sums, kind: str = "<f8") -> np.ndarray:
    """``sums`` of all rows, in one job.  One array a core reaches the driver."""

    def add(part: Iterator[tuple[int, bytes]]) -> Iterator[np.ndarray]:
        held = None
        for n, values in part:
            rows = np.frombuffer(values, kind).reshape(n, -1)
            found = sums(rows[:, :-2], rows[:, -2], rows[:, -1])
            held = found if held is None else held + found
        if held is not None:
            yield held

    cores = max(1, blocks.context.defaultParallelism)
    few = blocks.coalesce(cores) if blocks.getNumPartitions() > cores else blocks
    return sum(few.mapPartitions(add).collect())


# --- logistic models ----------------------------------------------------------------------------

def _logistic_sums(points: np.ndarray) -> Sums:
    """Loss, gradient and curvature of every row of ``points`` (coefficients, then the intercept)."""

    def sums(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
        a = np.concatenate((x, np.ones((len(x), 1))), axis=1)
        z = a @ points.T
        small = np.exp(-np.abs(z))
        loss = w @ (np.log1p(small) + np.maximum(z, 0.0) - y[:, None] * z)
        p = np.where(z >= 0, 1.0, small) / (1.0 + small)
        slope = (w[:, None] * (p - y[:, None])).T @ a
        bend = [(a * (w * p[:, j] * (1.0 - p[:, j]))[:, None]).T @ a for j in range(len(points))]
        return np.concatenate((loss, slope.ravel(), np.ravel(bend)))

    return sums


def newton_logistic(blocks: RDD, penalties: Sequence[float], max_iter: int = 1000, tol: float = 1e-6) -> list[np.ndarray]:
    """Coefficients, then the intercept, per penalty: minimises the weighted log loss plus half the penalty times the
    squared coefficients (not the intercept).

    All penalties are worked on in the same passes.  A step that raises the loss is halved.  A model is done when no
    number moves by more than ``tol``.
    """
    width = blocks.map(lambda block: len(block[1]) // (8 * block[0])).first() - 1  # features and the intercept
    points, steps = np.zeros((len(penalties), width)), np.zeros((len(penalties), width))
    lowest, opened = np.full(len(penalties), np.inf), list(range(len(penalties)))
    ridge = np.append(np.ones(width - 1), 0.0)
    for _ in range(max_iter):
        tried = points[opened] + steps[opened]
        found = total(blocks, _logistic_sums(tried))
        k = len(opened)
        loss, slope = found[:k], found[k : k + k * width].reshape(k, width)
        bend = found[k + k * width :].reshape(k, width, width)
        still = []
        for i, j in enumerate(opened):
            held = penalties[j] * ridge
            value = loss[i] + (held * tried[i] ** 2).sum() / 2
            if not value <= lowest[j] + 1e-12 * abs(lowest[j]):
                steps[j] /= 2
            else:
                points[j], lowest[j] = tried[i], value
                steps[j] = -np.linalg.lstsq(bend[i] + np.diag(held), slope[i] + held * tried[i], rcond=None)[0]
            if np.abs(steps[j]).max() > tol:
                still.append(j)
            else:
                points[j] = points[j] + steps[j] if np.isfinite(steps[j]).all() else points[j]
        opened = still
        if not opened:
            break
    return list(points)


# --- networks -----------------------------------------------------------------------------------

def layer_places(layers: Sequence[int]) -> list[tuple[slice, slice, int, int]]:
    """Per layer of weights: where its matrix (by columns of inputs) and its offsets are, inputs and outputs."""
    places, at = [], 0
    for inner, outer in zip(layers, layers[1:]):
        places.append((slice(at, at + inner * outer), slice(at + inner * outer, at + (inner + 1) * outer), inner, outer))
        at += (inner + 1) * outer
    return places


def _network_sums(flat: np.ndarray, layers: Sequence[int]) -> Sums:
    """Rows, cross entropy and its gradient of a network with sigmoid units and a softmax at its end.

    Units are worked out in the precision of the rows, sums of chunks are added in double precision.
    """
    places = layer_places(layers)

    def sums(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> np.ndarray:
        own = flat.astype(x.dtype)
        matrices = [own[m].reshape(inner, outer) for m, _, inner, outer in places]
        out = np.zeros(2 + len(flat))
        out[0] = len(x)
        for at in range(0, len(x), CHUNK_ROWS):  # small enough for all layers to stay near the core
            levels, kinds = [x[at : at + CHUNK_ROWS]], y[at : at + CHUNK_ROWS].astype(np.int64)
            for matrix, (_, offsets, _, _) in zip(matrices, places):
                z = levels[-1] @ matrix
                z += own[offsets]
                if len(levels) < len(places):
                    np.negative(z, out=z)
                    np.exp(np.minimum(z, 80.0, out=z), out=z)
                    z += 1.0
                    np.reciprocal(z, out=z)
                levels.append(z)
            z = levels.pop()
            z -= z.max(axis=1, keepdims=True)
            z -= np.log(np.exp(z).sum(axis=1, keepdims=True))
            row = np.arange(len(kinds))
            out[1] -= z[row, kinds].sum(dtype=np.float64)
            error = np.exp(z)
            error[row, kinds] -= 1.0
            for level, matrix, (m, offsets, _, _) in zip(reversed(levels), reversed(matrices), reversed(places)):
                out[2:][m] += (level.T @ error).ravel()
                out[2:][offsets] += error.sum(axis=0)
                if m.start:
                    error = error @ matrix.T
                    error *= level
                    error *= 1.0 - level
        return out

    return sums


def quasi_newton(value: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, max_iter: int, tol: float = 1e-6, memory: int = 10) -> tuple[np.ndarray, list[float]]:
    """Limited-memory BFGS with a line search for the strong Wolfe conditions: the point and the values of all steps.

    Ends after ``max_iter`` steps, when the gradient is below ``tol`` of the value, or when twenty steps lower the value by less
    than ``tol`` of the first one.
    """
    point, (now, slope) = start, value(start)
    values, pairs = [now], []
    for _ in range(max_iter):
        if np.linalg.norm(slope) <= tol * max(abs(now), 1e-12):
            break
        way, kept = -slope, []
        for s, y, r in reversed(pairs):
            a = r * (s @ way)
            kept.append(a)
            way = way - a * y
        if pairs:
            s, y, _ = pairs[-1]
            way = way * ((s @ y) / (y @ y))
        for (s, y, r), a in zip(pairs, reversed(kept)):
            way = way + s * (a - r * (y @ way))
        found = line_search(value, point, now, slope, way, 1.0 if pairs else 1.0 / np.linalg.norm(slope))
        if found is None:
            if not pairs:
                break
            pairs = []  # the memory misleads: go on along the gradient
            continue
        there, new, bend = found
        s, y = there - point, bend - slope
        if s @ y > 1e-12 * (y @ y):
            pairs = [*pairs[-(memory - 1) :], (s, y, 1.0 / (s @ y))]
        point, now, slope = there, new, bend
        values.append(now)
        if len(values) > 20 and max(values[-20:]) - now <= tol * abs(values[0]):
            break
    return point, values


def line_search(value, point: np.ndarray, now: float, slope: np.ndarray, way: np.ndarray, first: float, tries: int = 20):
    """Point, value and gradient along ``way`` where the value has fallen enough and the slope has flattened; none if not found."""
    down = slope @ way
    low, high, t, best = 0.0, np.inf, first, None
    for _ in range(tries):
        there = point + t * way
        new, bend = value(there)
        if not new <= now + 1e-4 * t * down:
            high = t
        else:
            if best is None or new < best[1]:
                best = there, new, bend
            along = bend @ way
            if abs(along) <= -0.9 * down:
                return there, new, bend
            if along > 0:
                high = t
            else:
                low = t
        t = 2.0 * t if high == np.inf else (low + high) / 2
    return best


def fit_network_weights(blocks: RDD, layers: Sequence[int], start: np.ndarray, max_iter: int, tol: float = 1e-6) -> tuple[np.ndarray, list[float]]:
    """Weights of the network and the mean losses of all steps, from ``start``."""

    def value(flat: np.ndarray) -> tuple[float, np.ndarray]:
        found = total(blocks, _network_sums(flat, layers), NETWORK_KIND)
        return found[1] / found[0], found[2:] / found[0]

    return quasi_newton(value, start, max_iter, tol)
