"""A linear classifier with L2 penalty and squared hinge loss, trained over all rows at every step.

The objective is ``|w|^2 / 2 + C * sum(max(0, 1 - y * (w.x + b))^2)``; the intercept ``b`` is the weight of a
further feature that is always ``intercept_scaling``, and is penalised like the others.  It is strictly
convex, so the minimum is the same for any partitioning.  Rows are packed once into sparse blocks; each step is
one pass over them, whose partial sums are added up (in a tree of tasks where they are many or long), and a
limited-memory quasi-Newton step on the driver, which holds a few vectors as long as the model.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD, StorageLevel
from pyspark.ml.classification import LinearSVCModel
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.sizing import settle

# Non-zero features of one block, about: a worker holds some arrays as long at a time.
BLOCK_CELLS = 1 << 18
# Rows of a batch from Spark that are packed at a time.
PACK_ROWS = 1000
# Steps remembered by the quasi-Newton method.
MEMORY = 20
# Partial sums of one pass up to this size go straight to the driver; beyond it they meet in a tree of tasks first.
DIRECT_BYTES = 32 << 20
DEPTH = 2


class Block(NamedTuple):
    """Some rows: where each starts among the cells, the cells, and the labels as -1 or 1."""

    starts: np.ndarray
    columns: np.ndarray
    values: np.ndarray
    signs: np.ndarray

    def times(self, w: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0.0], np.cumsum(self.values * w[self.columns])])
        return sums[self.starts[1:]] - sums[self.starts[:-1]]

    def gathered(self, rows: np.ndarray, n_cols: int) -> np.ndarray:
        """The sum of the rows, each times its number."""
        return np.bincount(self.columns, self.values * np.repeat(rows, np.diff(self.starts)), n_cols)


_PACKED = "starts binary, columns binary, data binary, signs binary"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as Spark stores them, sparse or dense, into blocks of bounded size."""
    for batch in (whole.slice(at, PACK_ROWS) for whole in batches for at in range(0, whole.num_rows, PACK_ROWS)):
        vectors = batch.column("features")
        labels = batch.column("label").to_numpy(zero_copy_only=False).astype(np.float64)
        if not np.isin(labels, (0.0, 1.0)).all():
            raise ValueError("a label is neither 0 nor 1")
        sparse = vectors.field("type").to_numpy(zero_copy_only=False) == 0
        values = vectors.field("values")
        long = pc.list_value_length(values).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(long)
        data = pc.list_flatten(values).to_numpy(zero_copy_only=False)
        columns = np.arange(len(data)) - np.repeat(ends - long, long)
        given = pc.list_flatten(vectors.field("indices")).to_numpy(zero_copy_only=False)
        columns[np.repeat(sparse, long)] = given
        first = 0
        while first < len(long):
            before = ends[first - 1] if first else 0
            stop = max(first + 1, int(np.searchsorted(ends, before + BLOCK_CELLS, "right")))
            cells = slice(before, ends[stop - 1])
            starts = np.concatenate([[0], ends[first:stop] - before])
            arrays = [
                starts.astype(np.int64), columns[cells].astype(np.int32), data[cells].astype(np.float64),
                2.0 * labels[first:stop] - 1.0,
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([a.tobytes()], pa.binary()) for a in arrays], names=["starts", "columns", "data", "signs"]
            )
            first = stop


def _block(row) -> Block:
    kinds = (np.int64, np.int32, np.float64, np.float64)
    return Block(*[np.frombuffer(bytes(b), k) for b, k in zip(row, kinds)])


class _Objective:
    """The objective and its gradient, each call one pass over the blocks."""

    def __init__(self, blocks: RDD, n_features: int, weight: float, constant: float):
        self._blocks, self._n, self._weight, self._constant = blocks, n_features, weight, constant
        self.passes = 0

    def _sum(self, part, size: int) -> np.ndarray:
        self.passes += 1
        direct = self._blocks.getNumPartitions() * size * 8 <= DIRECT_BYTES
        return self._blocks.treeAggregate(np.zeros(size), part, lambda a, b: a + b, 1 if direct else DEPTH)

    def curvature(self) -> np.ndarray:
        """The diagonal of the second derivative if every row were inside the margin."""
        n, constant, weight = self._n, self._constant, self._weight

        def part(total: np.ndarray, block: Block) -> np.ndarray:
            total[:n] += np.bincount(block.columns, block.values**2, n)
            total[n] += constant * constant * len(block.signs)
            return total

        return 1 + 2 * weight * self._sum(part, n + 1)

    def at(self, w: np.ndarray) -> tuple[float, np.ndarray]:
        n, constant, weight = self._n, self._constant, self._weight
        sent = self._blocks.context.broadcast(w)

        def part(total: np.ndarray, block: Block) -> np.ndarray:
            known = sent.value
            short = np.maximum(0.0, 1 - block.signs * (block.times(known) + known[n] * constant))
            pull = -2 * short * block.signs
            total[:n] += block.gathered(pull, n)
            total[n] += constant * pull.sum()
            total[n + 1] += (short * short).sum()
            return total

        total = self._sum(part, n + 2)
        sent.unpersist()
        return float(w @ w / 2 + weight * total[-1]), w + weight * total[:-1]


def _minimise(goal: _Objective, size: int, tol: float, max_iter: int) -> np.ndarray:
    """Limited-memory quasi-Newton steps, scaled by the curvature, each shortened until it goes down enough."""
    scale = 1 / goal.curvature()
    w = np.zeros(size)
    value, slope = goal.at(w)
    enough = tol * np.linalg.norm(slope)
    steps: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(max_iter):
        if np.linalg.norm(slope) <= enough:
            break
        direction, shares = slope.copy(), []
        for s, y, r in reversed(steps):
            shares.append(r * (s @ direction))
            direction -= shares[-1] * y
        direction *= scale
        if steps:
            s, y, r = steps[-1]
            direction *= 1 / (r * (y @ (scale * y)))
        for (s, y, r), share in zip(steps, reversed(shares)):
            direction += (share - r * (y @ direction)) * s
        down, length = slope @ direction, 1.0
        while True:
            new = w - length * direction
            new_value, new_slope = goal.at(new)
            if new_value <= value - 1e-4 * length * down or length < 1e-10:
                break
            # The minimum of the parabola through what is known, within limits.
            bend = new_value - value + length * down
            length = float(np.clip(down * length**2 / (2 * bend), 0.1 * length, 0.5 * length))
        s, y = new - w, new_slope - slope
        if s @ y > 0:
            steps = [*steps[1 - MEMORY :], (s, y, 1 / (s @ y))]
        stuck = value - new_value <= 1e-15 * abs(value)
        w, value, slope = new, new_value, new_slope
        if stuck:
            break
    return w


def fit_squared_hinge(
    training: DataFrame,
    C: float = 1.0,
    fit_intercept: bool = True,
    intercept_scaling: float = 1.0,
    tol: float = 1e-4,
    max_iter: int = 1000,
) -> LinearSVCModel:
    """The minimum of the objective, to a gradient of ``tol`` times that at zero, as Spark's linear model.

    ``training`` holds ``features`` (vectors of one length) and ``label`` (0 or 1).
    """
    if C <= 0:
        raise ValueError("C must be positive")
    first = training.select("features").first()
    if first is None:
        raise ValueError("there are no rows to learn from")
    n = first["features"].size
    packed = settle(training.select("features", F.col("label").cast("double").alias("label")).mapInArrow(_pack, _PACKED))
    blocks = packed.rdd.map(_block).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        goal = _Objective(blocks, n, C, intercept_scaling if fit_intercept else 0.0)
        w = _minimise(goal, n + 1, tol, max_iter)
    finally:
        blocks.unpersist()
    return _model(training, w[:n], float(w[n]) * intercept_scaling if fit_intercept else 0.0)


def _model(training: DataFrame, weights: np.ndarray, intercept: float) -> LinearSVCModel:
    """Spark's model with given weights, so that it predicts, is stored and loaded like any other."""
    context = training.sparkSession.sparkContext
    java = context._jvm.org.apache.spark.ml.classification.LinearSVCModel(
        f"squared_hinge_{abs(hash(weights.tobytes())):x}", _py2java(context, Vectors.dense(weights)), intercept
    )
    java.set(java.getParam("featuresCol"), "features")
    return LinearSVCModel(java)
