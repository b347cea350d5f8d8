"""Newton's method for multinomial logistic regression on a written table of sparse rows.

Rows are (idx, w, label, weight). Gradient and Hessian products are partial
sums: a task adds its rows up to one matrix of classes by features, and sums
of tasks are added in a tree, so no node gets more than a few of them. What
the driver keeps are some vectors of that size, which the vocabulary bounds.

A Newton step solves ``H d = -g``. With few features one pass adds the Hessian
up, and the driver solves; conjugate gradients would need a pass for each of
their steps, the more of them the more rows there are. With more features it is
conjugate gradients, and no matrix of features by features is made.
The steps end by the norm of the gradient, so the result does not depend on
how rows are dealt to tasks, but for rounding.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_STEPS = 100
MAX_INNER = 250
# sums of so many tasks are added by the driver itself; Hessians are far larger
FLAT, FLAT_HESSIANS = 64, 8
# classes times features, up to which the whole Hessian is made
MAX_HESSIAN = 1500
ROWS_AT_ONCE = 1024


class Rows:
    """Some rows as flat arrays."""

    def __init__(self, batch: pa.RecordBatch):
        idx, w = batch.column(0), batch.column(1)
        self.size = batch.num_rows
        sizes = idx.value_lengths().to_numpy(zero_copy_only=False)
        self.owner = np.repeat(np.arange(self.size), sizes)
        self.filled = np.flatnonzero(sizes)
        self.starts = (np.cumsum(sizes) - sizes)[self.filled]
        self.idx = idx.flatten().to_numpy().astype(np.int64)
        self.w = w.flatten().to_numpy()
        self.label = batch.column(2).to_numpy().astype(np.int64)
        self.weight = batch.column(3).to_numpy()

    def times(self, matrix: np.ndarray) -> np.ndarray:
        """Rows times ``matrix`` (classes by features, the intercept last)."""
        out = np.empty((self.size, len(matrix)))
        out[:] = matrix[:, -1]
        if len(self.filled):
            for c, line in enumerate(matrix):
                out[self.filled, c] += np.add.reduceat(self.w * line[self.idx], self.starts)
        return out

    def back(self, values: np.ndarray, features: int) -> np.ndarray:
        """``values`` (rows by classes), transposed, times rows."""
        out = np.empty((values.shape[1], features + 1))
        for c in range(values.shape[1]):
            out[c, :-1] = np.bincount(self.idx, self.w * values[self.owner, c], features)
            out[c, -1] = values[:, c].sum()
        return out

    def probabilities(self, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of all classes, and the loss of each row."""
        z = self.times(matrix)
        top = z.max(axis=1, keepdims=True)
        e = np.exp(z - top)
        total = e.sum(axis=1, keepdims=True)
        own = z[np.arange(self.size), self.label]
        return e / total, np.log(total[:, 0]) + top[:, 0] - own


def loss_and_gradient(rows: Rows, matrix: np.ndarray) -> np.ndarray:
    """The weighted loss of ``rows``, and behind it the gradient, without the penalty."""
    p, loss = rows.probabilities(matrix)
    p[np.arange(rows.size), rows.label] -= 1
    gradient = rows.back(p * rows.weight[:, None], matrix.shape[1] - 1)
    return np.append(loss @ rows.weight, gradient)


def hessian_product(rows: Rows, matrix: np.ndarray, direction: np.ndarray) -> np.ndarray:
    """The Hessian of the weighted loss of ``rows`` at ``matrix``, times ``direction``, without the penalty."""
    p, _ = rows.probabilities(matrix)
    z = rows.times(direction)
    q = p * (z - (p * z).sum(axis=1, keepdims=True)) * rows.weight[:, None]
    return rows.back(q, matrix.shape[1] - 1).ravel()


def _class_pairs(classes: int) -> list[tuple[int, int]]:
    return [(c, d) for c in range(classes) for d in range(c, classes)]


def hessian(rows: Rows, matrix: np.ndarray) -> np.ndarray:
    """The Hessian of the weighted loss of ``rows`` without the penalty: a block for each pair of classes, one after the other."""
    width, pairs = matrix.shape[1], _class_pairs(len(matrix))
    p, _ = rows.probabilities(matrix)
    out = np.zeros((len(pairs), width, width))
    for at in range(0, rows.size, ROWS_AT_ONCE):
        end = min(at + ROWS_AT_ONCE, rows.size)
        low, high = np.searchsorted(rows.owner, [at, end])
        dense = np.zeros((end - at, width))
        np.add.at(dense, (rows.owner[low:high] - at, rows.idx[low:high]), rows.w[low:high])
        dense[:, -1] = 1.0
        for block, (c, d) in zip(out, pairs):
            q = rows.weight[at:end] * p[at:end, c] * ((c == d) - p[at:end, d])
            block += dense.T @ (q[:, None] * dense)
    return out.ravel()


def _solved(blocks: np.ndarray, shape: tuple[int, int], ridge: np.ndarray, gradient: np.ndarray) -> np.ndarray | None:
    """The Newton step from the blocks of :func:`hessian`; None if the matrix can't be solved in double precision."""
    classes, width = shape
    full = np.empty((classes, width, classes, width))
    for block, (c, d) in zip(blocks.reshape(-1, width, width), _class_pairs(classes)):
        full[c, :, d, :], full[d, :, c, :] = block, block.T
    full = full.reshape(classes * width, classes * width)
    full[np.diag_indices_from(full)] += ridge.ravel()
    # one shift of all intercepts changes no probability; no step goes that way
    shift = (np.arange(classes * width) % width == width - 1).astype(float)
    full += np.outer(shift, shift) * (full.trace() / len(full))
    try:
        step = np.linalg.solve(full, -gradient)
    except np.linalg.LinAlgError:
        return None
    return step if gradient @ step < 0 else None


def _added(table: DataFrame, tasks: int, part: Callable[[Rows], np.ndarray], flat: int | None = None) -> np.ndarray:
    """``part`` of all rows, added up: in each of the ``tasks``, then over groups of tasks, then here."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: np.ndarray | None = None
        for batch in batches:
            if batch.num_rows:
                found = part(Rows(batch))
                total = found if total is None else total + found
        if total is not None:
            number = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), pa.array([total.tobytes()], pa.binary())], ["task", "total"])

    def together(group: pa.Table) -> pa.Table:
        order = np.argsort(group.column("task").to_numpy())  # rounding does not depend on who came first
        total = sum(np.frombuffer(group.column("total")[int(i)].as_py()) for i in order)
        return pa.table({"task": [group.column("task")[int(order[0])].as_py()], "total": [total.tobytes()]})

    sums = table.mapInArrow(task, "task long, total binary")
    while tasks > (flat or FLAT):
        tasks = isqrt(tasks)
        sums = sums.groupBy(F.col("task") % tasks).applyInArrow(together, "task long, total binary")
    return sum(np.frombuffer(r.total) for r in sorted(sums.collect(), key=lambda r: r.task))


def fit(table: DataFrame, classes: int, features: int, penalty: float, tolerance: float = 1e-11) -> np.ndarray:
    """Classes by features, the intercept last, that minimise the weighted loss plus ``penalty`` |weights|^2 / 2.

    ``table`` has idx (array of int), w (array of double), label (from 0) and
    weight, and is read in every step. Intercepts are not penalised. It ends
    when the norm of the gradient is ``tolerance`` times that at the start, or
    can get no smaller in double precision.
    """
    shape, tasks = (classes, features + 1), table.rdd.getNumPartitions()
    ridge = np.full(shape, penalty)
    ridge[:, -1] = 0.0

    def at(x: np.ndarray) -> tuple[float, np.ndarray]:
        found = _added(table, tasks, lambda rows: loss_and_gradient(rows, x.reshape(shape)))
        return found[0] + 0.5 * float(x @ (ridge.ravel() * x)), found[1:] + ridge.ravel() * x

    def product(x: np.ndarray, direction: np.ndarray) -> np.ndarray:
        found = _added(table, tasks, lambda rows: hessian_product(rows, x.reshape(shape), direction.reshape(shape)))
        return found + ridge.ravel() * direction

    x = np.zeros(classes * (features + 1))
    value, gradient = at(x)
    start = np.linalg.norm(gradient)
    for _ in range(MAX_STEPS):
        size = np.linalg.norm(gradient)
        if size <= tolerance * start:
            break
        # the closer to the end, the more exact the step, but not beyond what is asked for
        enough = max(min(0.1, size / start) * size, 0.3 * tolerance * start)
        step = None
        if x.size <= MAX_HESSIAN:
            blocks = _added(table, tasks, lambda rows: hessian(rows, x.reshape(shape)), FLAT_HESSIANS)
            step = _solved(blocks, shape, ridge, gradient)
        if step is None:
            step = _conjugate(lambda d: product(x, d), -gradient, enough)
        slope, length = float(gradient @ step), 1.0
        while True:
            tried, new = at(x + length * step)
            # near the end the value's last digits say nothing, the gradient still does
            if tried <= value + 1e-4 * length * slope or np.linalg.norm(new) < 0.5 * size:
                break
            length /= 2
            if length < 1e-6:
                return x.reshape(shape)
        x, value, gradient = x + length * step, tried, new
        if size <= 1e-7 * start and np.linalg.norm(gradient) > 0.5 * size:
            break  # as far as rounding allows
    return x.reshape(shape)


def _conjugate(product: Callable[[np.ndarray], np.ndarray], right: np.ndarray, enough: float) -> np.ndarray:
    """``d`` with ``product(d)`` about ``right``: the rest is at most ``enough`` long."""
    d, rest = np.zeros_like(right), right.copy()
    way, size = rest.copy(), float(rest @ rest)
    for _ in range(MAX_INNER):
        moved = product(way)
        bend = float(way @ moved)
        if bend <= 0:
            break
        d += size / bend * way
        rest -= size / bend * moved
        new = float(rest @ rest)
        if new**0.5 <= enough:
            break
        way = rest + new / size * way
        size = new
    return d
