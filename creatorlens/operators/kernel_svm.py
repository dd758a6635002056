"""M4: one-vs-one support vector classification with an RBF kernel, by a cascade of dual solvers.

For each pair of classes the soft-margin dual is solved (0 <= alpha <= C, sum of alpha y = 0).  Rows are dealt into
parts of ``PART`` rows at most; every part is solved in its own task together with the support vectors known so far.
Support vectors of two parts meet in the next layer, until one set is left (Graf et al. 2005).  One pass over all
rows then measures the KKT gap of that solution; as long as it is above ``tol`` the support vectors go back to all
parts for another round.  A pass in which no row violates the conditions proves the optimum of the whole problem.

Prediction is a vote of all pairs; equal votes go to the class that comes first.  The kernel width is
``1 / (dimensions * variance)`` by default, as in common libraries.

Bounds: a task holds one part's kernel matrix (``PART`` rows and the support vectors), the driver the support vectors
of the pairs.  ``train_most`` bounds the training rows (those with the smallest hash of their key); the support
vectors, and so what is shipped, cannot be more.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from creatorlens.session import materialize

PART, ROUNDS, TRAIN_MOST = 1000, 20, 20_000
BATCH = 2048


def rbf(x: np.ndarray, y: np.ndarray, gamma: float) -> np.ndarray:
    return np.exp(-gamma * np.maximum((x * x).sum(1)[:, None] - 2.0 * (x @ y.T) + (y * y).sum(1)[None, :], 0.0))


def solve_dual(kernel: np.ndarray, y: np.ndarray, c: float, tol: float, alpha: np.ndarray | None = None, most: int = 200_000) -> np.ndarray:
    """The dual variables by pairwise steps: the most violating row, and the partner with the greatest gain."""
    alpha = np.zeros(len(y)) if alpha is None else alpha.copy()
    value = y - kernel @ (alpha * y)  # y minus the decision without its offset
    edge = 1e-12 * c
    for _ in range(most):
        up = np.where(y > 0, alpha < c - edge, alpha > edge)
        low = np.where(y > 0, alpha > edge, alpha < c - edge)
        if not up.any() or not low.any():
            break
        i = int(np.argmax(np.where(up, value, -np.inf)))
        gap = value[i] - value
        if gap[low].max() <= tol:
            break
        curve = np.maximum(kernel[i, i] + np.diag(kernel) - 2.0 * kernel[i], 1e-12)
        j = int(np.argmax(np.where(low & (gap > 0), gap * gap / curve, -np.inf)))
        step = gap[j] / curve[j]
        step = min(step, c - alpha[i] if y[i] > 0 else alpha[i], alpha[j] if y[j] > 0 else c - alpha[j])
        alpha[i] += y[i] * step
        alpha[j] -= y[j] * step
        value -= step * (kernel[i] - kernel[j])
    return alpha


@dataclass
class PairModel:
    """The decision between two classes: positive for ``first``."""
    first: str
    second: str
    vectors: np.ndarray
    weights: np.ndarray  # alpha y
    offset: float
    gap: float

    def decide(self, x: np.ndarray, gamma: float) -> np.ndarray:
        return rbf(x, self.vectors, gamma) @ self.weights + self.offset if len(self.weights) else np.full(len(x), self.offset)


@dataclass
class KernelModel:
    classes: list[str]
    gamma: float
    pairs: list[PairModel]
    rounds: int

    @property
    def gap(self) -> float:
        return max((p.gap for p in self.pairs), default=0.0)

    def votes(self, x: np.ndarray) -> list[str]:
        if not self.classes:
            return [None] * len(x)
        count = np.zeros((len(x), len(self.classes)), int)
        for p in self.pairs:
            first = p.decide(x, self.gamma) > 0
            count[:, self.classes.index(p.first)] += first
            count[:, self.classes.index(p.second)] += ~first
        return [self.classes[i] for i in count.argmax(1)]


def _pair_rows(rows: DataFrame, classes: list[str]) -> DataFrame:
    """(pair, y, key, x): every row once for each pair that its class takes part in."""
    pairs = list(itertools.combinations(classes, 2))
    own = {k: [(i, 1.0 if k == a else -1.0) for i, (a, b) in enumerate(pairs) if k in (a, b)] for k in classes}

    def told(k: str) -> Column:
        return F.array(*[F.struct(F.lit(i).alias("pair"), F.lit(y).alias("y")) for i, y in own[k]])

    each = F.coalesce(*[F.when(F.col("label") == k, told(k)) for k in classes])
    return rows.select("key", "x", F.explode(each).alias("t")).select("t.pair", "t.y", "key", "x")


def fit_kernel_svm(rows: DataFrame, label: str, features: str, key: str, *, c: float = 1.0, gamma: float | None = None,
                   tol: float = 1e-3, part: int = PART, rounds: int = ROUNDS, train_most: int = TRAIN_MOST) -> KernelModel:
    """The pairs' decisions learned from ``rows``: a class name, an array<double> and a unique key.

    Rows with a null label or vector are left out."""
    base = rows.select(F.col(label).cast("string").alias("label"), F.col(features).cast("array<double>").alias("x"), F.xxhash64(F.col(key), F.lit(5)).alias("key"))
    base = materialize(base.where(F.col("label").isNotNull() & F.col("x").isNotNull()).orderBy("key").limit(train_most))
    classes = sorted(r.label for r in base.select("label").distinct().collect())
    if gamma is None:
        add = lambda f: F.aggregate("x", F.lit(0.0), lambda s, v: s + f(v))
        n, d, s, q = base.select(F.size("x").alias("d"), add(lambda v: v).alias("s"), add(lambda v: v * v).alias("q")).agg(
            F.count("*"), F.max("d"), F.sum("s"), F.sum("q")).first()
        spread = q / (n * d) - (s / (n * d)) ** 2 if n and d else 0.0
        gamma = 1.0 / (d * spread) if spread > 0 else 1.0
    names = list(itertools.combinations(classes, 2))
    if not names:
        return KernelModel(classes, gamma, [], 0)
    data = materialize(_pair_rows(base, classes))
    counts = {r.pair: r.n for r in data.groupBy("pair").agg(F.count("*").alias("n")).collect()}
    parts = {p: max(-(-n // part), 1) for p, n in counts.items()}
    deal = F.coalesce(*[F.when(F.col("pair") == p, F.pmod(F.xxhash64("key"), F.lit(n))) for p, n in parts.items()]).cast("int")
    data = data.withColumn("part", deal)
    schema = "pair int, part int, key long, y double, alpha double, x array<double>"
    known = {p: [] for p in counts}  # (key, y, alpha, x) of the support vectors

    def solver(known: dict):
        def solve(table: pa.Table) -> pa.Table:
            pair, at = table.column("pair")[0].as_py(), table.column("part")[0].as_py()
            own = dict(zip(table.column("key").to_pylist(), zip(table.column("y").to_pylist(), table.column("alpha").to_pylist(), table.column("x").to_pylist())))
            own.update({k: (y, a, x) for k, y, a, x in known.get(pair, ())})
            keys = sorted(own)
            y, x = np.array([own[k][0] for k in keys]), np.array([own[k][2] for k in keys], dtype=float)
            alpha = np.array([own[k][1] for k in keys])
            start = alpha if abs((alpha * y).sum()) < 1e-9 * max(c, 1.0) * len(y) else None  # only a feasible start is one
            alpha = solve_dual(rbf(x, x, gamma), y, c, tol / 4, start)
            some = [i for i in range(len(keys)) if alpha[i] > 1e-12 * c]
            return pa.table({"pair": pa.array([pair] * len(some), pa.int32()), "part": pa.array([at] * len(some), pa.int32()),
                             "key": pa.array([keys[i] for i in some], pa.int64()), "y": pa.array(y[some].tolist(), pa.float64()),
                             "alpha": pa.array(alpha[some].tolist(), pa.float64()), "x": pa.array([x[i].tolist() for i in some], pa.list_(pa.float64()))})
        return solve

    zero = F.lit(0.0).alias("alpha")
    models: list[PairModel] = []
    for turn in range(1, rounds + 1):
        layer = data.select("pair", "part", "key", "y", zero, "x").groupBy("pair", "part").applyInArrow(solver(known), schema)
        left = max(parts.values())
        while left > 1:  # the support vectors of two parts meet
            layer = materialize(layer).select("pair", F.floor(F.col("part") / 2).cast("int").alias("part"), "key", "y", zero, "x")
            layer = layer.dropDuplicates(["pair", "part", "key"]).groupBy("pair", "part").applyInArrow(solver({}), schema)
            left = -(-left // 2)
        known = {p: [] for p in counts}
        for r in layer.collect():
            known[r.pair].append((r.key, r.y, r.alpha, r.x))
        models = _measured(data, known, names, c, gamma)
        if max(m.gap for m in models) <= tol:
            break
    return KernelModel(classes, gamma, models, turn)


def _measured(data: DataFrame, known: dict, names: list[tuple[str, str]], c: float, gamma: float) -> list[PairModel]:
    """The pairs' models with their KKT gap over all rows (one pass, one row a pair comes back)."""
    vectors = {p: np.array([x for *_, x in rows], dtype=float) for p, rows in known.items()}
    weights = {p: np.array([y * a for _, y, a, _ in rows]) for p, rows in known.items()}
    alphas = {p: {k: a for k, _, a, _ in rows} for p, rows in known.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, BATCH):
                some = batch.slice(i, BATCH)
                pair, y = np.array(some.column(0).to_pylist()), np.array(some.column(1).to_pylist())
                keys, x = some.column(2).to_pylist(), np.array(some.column(3).to_pylist(), dtype=float)
                for p in np.unique(pair).tolist():
                    at = np.flatnonzero(pair == p)
                    value = y[at] - (rbf(x[at], vectors[p], gamma) @ weights[p] if len(weights[p]) else 0.0)
                    alpha = np.array([alphas[p].get(keys[j], 0.0) for j in at])
                    up = np.where(y[at] > 0, alpha < c * (1 - 1e-9), alpha > 0)
                    low = np.where(y[at] > 0, alpha > 0, alpha < c * (1 - 1e-9))
                    most, least = value[up].max(initial=-np.inf), value[low].min(initial=np.inf)
                    yield pa.RecordBatch.from_arrays([pa.array([p], pa.int32()), pa.array([float(most)]), pa.array([float(least)])], names=["pair", "most", "least"])

    found = {r.pair: r for r in data.select("pair", "y", "key", "x").mapInArrow(run, "pair int, most double, least double")
             .groupBy("pair").agg(F.max("most").alias("most"), F.min("least").alias("least")).collect()}
    out = []
    for p, (a, b) in enumerate(names):
        most, least = found[p].most, found[p].least
        bounded = np.isfinite(most) and np.isfinite(least)
        out.append(PairModel(a, b, vectors[p], weights[p], (most + least) / 2 if bounded else 0.0, most - least if bounded else 0.0))
    return out


def predict_kernel_svm(model: KernelModel, rows: DataFrame, features: str, out: str = "prediction") -> DataFrame:
    """``rows`` with the class that most pairs vote for (null vectors: null)."""
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    at = rows.columns.index(features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, BATCH):
                part = batch.slice(i, BATCH)
                values = part.column(at).to_pylist()
                fine = [r for r, v in enumerate(values) if v is not None]
                said: list = [None] * len(values)
                if fine:
                    for r, v in zip(fine, model.votes(np.array([values[r] for r in fine], dtype=float))):
                        said[r] = v
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(said, pa.string())], names=[*part.schema.names, out])

    return rows.mapInArrow(run, f"{kept}, `{out}` string")
