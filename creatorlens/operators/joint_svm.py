"""Linear SVMs over the same rows, fitted side by side (M5).

MLlib's ``LinearSVC`` fits one classifier for one constant C at a time, and each of its iterations is a job: a grid over
kernels, constants, classes and folds is thousands of small ones.  Here every classifier of a fold asks for loss and
gradient at a few points, one pass over the rows answers all of them, and each takes its own step.

The problem is that of ``LinearSVC``: mean hinge loss + ``reg / 2 * |w|^2`` over features that are centred and scaled to
unit deviation, the offset not penalised.  The method is L-BFGS; a step takes the best of several lengths, which one pass
tries.  Rows are sparse vectors; the rbf kernel's random Fourier features are made from them in the pass and never
stored.  The driver holds the sums of a pass: as many as features times classifiers times lengths.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Generator, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from creatorlens.operators.kernels import projection

#: values that are multiplied out at once, and tasks whose sums the driver adds up by itself
STRETCH, DIRECT = 1 << 12, 64
#: L-BFGS pairs (and losses that the last one is compared with); lengths that a step is tried at, how often, and by how much
#: of what the slope promises its loss must fall
MEMORY, STEPS, SEARCH, ARMIJO = 10, (4.0, 1.0, 0.25, 0.0625), 3, 1e-4


@dataclass(frozen=True)
class Kernel:
    """The features of a kernel over vectors of ``dim`` values: these themselves, or ``width`` random Fourier features."""
    name: str
    dim: int
    width: int
    gamma: float = 1.0
    seed: int = 0


class Sparse:
    """Rows of which row i has the values from ``start[i]`` to ``start[i + 1]``, each at its ``index``."""

    def __init__(self, start: np.ndarray, index: np.ndarray, value: np.ndarray, dim: int):
        self.index, self.value, self.dim, self.first, self.size = index, value, dim, start[:-1], np.diff(start)

    def times(self, a: np.ndarray) -> np.ndarray:
        out = np.zeros((len(self.size), a.shape[1]))
        rows, j = np.flatnonzero(self.size), 0
        while len(rows):  # the j-th value of every row that has so many
            at = self.first[rows] + j
            out[rows] += self.value[at][:, None] * a[self.index[at]]
            j += 1
            rows = rows[self.size[rows] > j]
        return out

    def back(self, r: np.ndarray) -> np.ndarray:
        """These rows, transposed, times ``r``."""
        spread = self.value * np.repeat(r, self.size, axis=0).T
        return np.stack([np.bincount(self.index, weights=column, minlength=self.dim) for column in spread], axis=1)

    def squares(self) -> np.ndarray:
        return np.bincount(self.index, weights=self.value ** 2, minlength=self.dim)


class Dense:
    def __init__(self, x: np.ndarray):
        self.x = x

    def times(self, a: np.ndarray) -> np.ndarray:
        return self.x @ a

    def back(self, r: np.ndarray) -> np.ndarray:
        return self.x.T @ r

    def squares(self) -> np.ndarray:
        return (self.x ** 2).sum(0)


def _features(x: Sparse, kernel: Kernel) -> Sparse | Dense:
    if kernel.name == "linear":
        return x
    w, b, scale = projection(kernel.dim, kernel.width, kernel.gamma, kernel.seed)
    z = x.times(w)
    z += b
    np.cos(z, out=z)
    z *= scale
    return Dense(z)


def _stretches(batch: pa.RecordBatch, dim: int) -> Iterator[tuple[np.ndarray, Sparse]]:
    """Labels and vectors of a batch, a few rows at a time."""
    label, vector = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
    index, value = vector.field("indices"), vector.field("values")
    if index.null_count:
        raise ValueError("the vectors must be sparse")
    start = np.concatenate([[0], np.cumsum(pc.list_value_length(index).to_numpy())]).astype(np.int64)
    index, value = index.flatten().to_numpy(), value.flatten().to_numpy()
    at = 0
    while at < len(label):
        to = int(np.searchsorted(start, start[at] + STRETCH, side="right")) - 1
        to = min(max(to, at + 1), at + STRETCH, len(label))
        yield label[at:to], Sparse(start[at:to + 1] - start[at], index[start[at]:start[to]], value[start[at]:start[to]], dim)
        at = to


def _summed(many: Iterator[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
    sums = None
    for arrays in many:
        sums = arrays if sums is None else [a + b for a, b in zip(sums, arrays, strict=True)]
    if sums is not None:
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(sums)], pa.binary())], ["sums"])


def totals(rows: DataFrame, dim: int, work: Callable[[np.ndarray, Sparse], list[np.ndarray]]) -> list[np.ndarray] | None:
    """The arrays that ``work`` makes of labels and vectors, summed over all rows ``(label, vector)``; None without rows."""
    def of_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _summed(work(label, x) for batch in batches for label, x in _stretches(batch, dim))

    def of_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _summed(pickle.loads(one.as_py()) for batch in batches for one in batch.column(0))

    got = rows.mapInArrow(of_rows, "sums binary")
    if (tasks := rows.sparkSession.sparkContext.defaultParallelism) > DIRECT:
        got = got.repartition(math.isqrt(tasks)).mapInArrow(of_sums, "sums binary")
    sums = [pickle.loads(r[0]) for r in got.collect()]
    return [sum(arrays) for arrays in zip(*sums, strict=True)] if sums else None


def _direction(gradient: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    d, parts = -gradient, []
    for s, y in reversed(pairs):
        part = (s @ d) / (s @ y)
        parts.append(part)
        d = d - part * y
    if pairs:
        s, y = pairs[-1]
        d = d * ((s @ y) / (y @ y))
    for (s, y), part in zip(pairs, reversed(parts), strict=True):
        d = d + (part - (y @ d) / (s @ y)) * s
    return d


def descend(size: int, max_iter: int, tol: float) -> Generator[list[np.ndarray], list[tuple[float, np.ndarray]], np.ndarray]:
    """Minimise from zero: yields points at which it wants loss and gradient, returns the last point it took.  It ends
    after ``max_iter`` steps, or as LinearSVC does by ``tol``: by the gradient's length as a part of the loss, or if the
    last ``MEMORY`` losses differ by less than that part of the first one.

    A step has the best of several lengths, as one pass answers for all of them; if none is better, of shorter ones."""
    x = np.zeros(size)
    ((loss, gradient),) = yield [x]
    losses, pairs = [loss], []
    for _ in range(max_iter):
        length = float(np.linalg.norm(gradient))
        if length <= max(tol * abs(loss), 1e-8) or loss <= 1e-12 * abs(losses[0]) or len(losses) > MEMORY and max(losses[-MEMORY:]) - loss <= tol * abs(losses[0]):
            break
        d = _direction(gradient, pairs)
        if (slope := d @ gradient) >= 0:
            pairs, d, slope = [], -gradient, -length ** 2
        unit, taken = 1.0 if pairs else 1.0 / length, None
        for k in range(SEARCH):
            steps = [unit * (STEPS[-1] / STEPS[0] / 2) ** k * step for step in STEPS]
            points = [x + step * d for step in steps]
            got = yield points
            better = [(value, i) for i, (step, (value, _)) in enumerate(zip(steps, got, strict=True)) if value <= loss + ARMIJO * step * slope]
            if better:
                taken = min(better)[1]
                break
        if taken is None:
            if not pairs:
                break
            pairs = []
            continue
        (value, turned), there = got[taken], points[taken]
        s, y = there - x, turned - gradient
        if s @ y > 1e-12 * (y @ y):
            pairs = [*pairs, (s, y)][-MEMORY:]
        x, loss, gradient = there, value, turned
        losses.append(loss)
    return x


@dataclass
class Fitted:
    """Weights (features x classifiers) and offsets of a kernel's classifiers, those of each constant side by side."""
    kernel: Kernel
    weights: np.ndarray
    offsets: np.ndarray


def fit_together(rows: DataFrame, kernels: Sequence[Kernel], classes: int, regs: Sequence[float], *, max_iter: int, tol: float) -> list[Fitted]:
    """One-vs-rest classifiers of ``classes`` classes for each kernel and each of ``regs``, over rows ``(label, vector)``
    that can be read many times."""
    dim = kernels[0].dim

    def moments(label: np.ndarray, x: Sparse) -> list[np.ndarray]:
        made = [_features(x, kernel) for kernel in kernels]
        return [np.array([len(label)]), *[a for f in made for a in (f.back(np.ones((len(label), 1)))[:, 0], f.squares())]]

    (n,), *found = totals(rows, dim, moments)
    n = int(n)
    means, scales = [], []
    for total, squares in zip(found[::2], found[1::2], strict=True):
        mean = total / n
        spread = squares - n * mean ** 2
        spread[spread <= 1e-12 * squares] = 0.0  # of a constant feature, the rest of a difference
        deviation = np.sqrt(spread / max(n - 1, 1))
        means.append(mean)
        scales.append(np.divide(1.0, deviation, out=np.zeros_like(deviation), where=deviation > 0))

    def raw(k: int, points: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Weights and offsets over the features as they are, of points over centred and scaled ones."""
        p = np.stack(points, axis=1)
        weights = p[:-1] * scales[k][:, None]
        return weights, p[-1] - means[k] @ weights

    running = {(k, r, c): descend(kernel.width + 1, max_iter, tol) for k, kernel in enumerate(kernels) for r in range(len(regs)) for c in range(classes)}
    wanted, ended = {key: next(one) for key, one in running.items()}, {}
    while wanted:
        tasks, order = [], []
        for k, kernel in enumerate(kernels):
            if own := [(key, point) for key, points in wanted.items() if key[0] == k for point in points]:
                tasks.append((kernel, *raw(k, [point for _, point in own]), np.array([key[2] for key, _ in own], dtype=float)))
                order.append(own)

        def hinge(label: np.ndarray, x: Sparse, tasks=tasks) -> list[np.ndarray]:
            out = []
            for kernel, weights, offsets, own in tasks:
                f = _features(x, kernel)
                y = np.where(label[:, None] == own, 1.0, -1.0)
                short = 1.0 - y * (f.times(weights) + offsets)
                pull = np.where(short > 0, -y, 0.0)
                out += [np.maximum(short, 0.0).sum(0), pull.sum(0), f.back(pull)]
            return out

        got, answers = totals(rows, dim, hinge), {key: [] for key in wanted}
        for own, losses, pulls, backs in zip(order, got[::3], got[1::3], got[2::3], strict=True):
            for at, ((k, r, c), point) in enumerate(own):
                w = point[:-1]
                gradient = scales[k] * (backs[:, at] - means[k] * pulls[at]) / n + regs[r] * w
                answers[k, r, c].append((float(losses[at] / n + regs[r] / 2 * (w @ w)), np.append(gradient, pulls[at] / n)))
        wanted = {}
        for key, answer in answers.items():
            try:
                wanted[key] = running[key].send(answer)
            except StopIteration as end:
                ended[key] = end.value
    return [Fitted(kernel, *raw(k, [ended[k, r, c] for r in range(len(regs)) for c in range(classes)])) for k, kernel in enumerate(kernels)]


def shares(rows: DataFrame, fitted: Sequence[Fitted], classes: int) -> list[list[float]]:
    """For each kernel and constant the share of rows ``(label, vector)`` whose class has the greatest score (the first of
    equal ones), in one pass; 0 without rows."""
    def hits(label: np.ndarray, x: Sparse) -> list[np.ndarray]:
        out = [np.array([len(label)])]
        for one in fitted:
            scores = _features(x, one.kernel).times(one.weights) + one.offsets
            best = scores.reshape(len(label), -1, classes).argmax(2)
            out.append((best == label[:, None]).sum(0))
        return out

    got = totals(rows, fitted[0].kernel.dim, hits)
    if got is None:
        return [[0.0] * (len(one.offsets) // classes) for one in fitted]
    return [(own / got[0][0]).tolist() for own in got[1:]]
