"""M2: a non-linear 2-D map of points by landmark t-SNE, and its trustworthiness.

The map is fitted on ``landmarks`` rows (those with the smallest hash of their id, a documented bound that does not
grow with the data) by t-SNE: neighbour probabilities of a given perplexity in the feature space, Student-t
similarities on the map, gradient descent with momentum from the landmarks' principal components.  Every row is then
placed in its own task, at the mean of its nearest landmarks' places weighted by inverse squared distance, so the
cost is one matrix product per batch and no pair of rows is formed.

``trustworthiness`` tells how far the neighbours on the map are neighbours in the feature space (Venna and Kaski
2001).  It is exact for a stated set of query rows against all rows: each task reduces its rows to the k nearest of
every query, then one pass counts how many rows are nearer in the feature space.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LANDMARKS, PERPLEXITY, NEAREST, ITERATIONS = 400, 30.0, 5, 400
BATCH = 2048  # rows compared with all landmarks or queries at once


def squared_distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2.0 * (x @ y.T) + (y * y).sum(1)[None, :], 0.0)


def neighbour_probabilities(x: np.ndarray, perplexity: float) -> np.ndarray:
    """Symmetric neighbour probabilities: each row's Gaussian has the given perplexity (bisection on its width)."""
    far, n = squared_distances(x, x), len(x)
    np.fill_diagonal(far, np.inf)
    far -= far.min(1)[:, None]
    low, high, beta = np.zeros(n), np.full(n, np.inf), np.full(n, 1.0 / max(float(np.median(far[np.isfinite(far)])), 1e-12))
    goal = np.log(min(perplexity, max((n - 1) / 3.0, 1.0)))
    with np.errstate(invalid="ignore"):
        for _ in range(60):
            p = np.exp(-far * beta[:, None])
            total = p.sum(1)
            entropy = np.log(total) + beta * np.where(np.isfinite(far), far * p, 0.0).sum(1) / total
            wide = entropy > goal
            low, high = np.where(wide, beta, low), np.where(wide, high, beta)
            beta = np.where(np.isinf(high), beta * 2.0, (low + high) / 2.0)
    p /= total[:, None]
    return np.maximum((p + p.T) / (2.0 * n), 1e-12)


def tsne(x: np.ndarray, perplexity: float = PERPLEXITY, iterations: int = ITERATIONS) -> np.ndarray:
    """t-SNE of a bounded number of points to two dimensions, started from their principal components."""
    n = len(x)
    if n < 4:
        return np.column_stack([np.arange(n, dtype=float), np.zeros(n)])
    centred = x - x.mean(0)
    _, _, axes = np.linalg.svd(centred, full_matrices=False)
    y = centred @ axes[:2].T if len(axes) > 1 else np.column_stack([centred[:, 0], np.zeros(n)])
    y = y / max(y[:, 0].std(), 1e-12) * 1e-4
    p = neighbour_probabilities(x, perplexity)
    speed, gain, rate = np.zeros_like(y), np.ones_like(y), max(n / 12.0 / 4.0, 50.0)
    early = min(100, iterations // 4)
    for step in range(iterations):
        near = 1.0 / (1.0 + squared_distances(y, y))
        np.fill_diagonal(near, 0.0)
        pull = (p * (12.0 if step < early else 1.0) - near / near.sum()) * near
        slope = 4.0 * (pull.sum(1)[:, None] * y - pull @ y)
        gain = np.maximum(np.where(np.sign(slope) != np.sign(speed), gain + 0.2, gain * 0.8), 0.01)
        speed = (0.5 if step < early else 0.8) * speed - rate * gain * slope
        y = y + speed
        y -= y.mean(0)
    return y


def _vectors(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), dtype=float).reshape(len(column), -1)


def _usable(points: DataFrame, features: str) -> DataFrame:
    x = F.col(features).cast("array<double>")
    return points.where(x.isNotNull() & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))))


def neighbour_map(points: DataFrame, id_col: str = "id", features: str = "features", *, landmarks: int = LANDMARKS,
                  perplexity: float = PERPLEXITY, nearest: int = NEAREST, iterations: int = ITERATIONS, out: str = "projection") -> DataFrame:
    """M2: every row with its place ``out`` (array<double> of two) on the landmark t-SNE map.

    Rows whose vector is null or holds a null, NaN or infinity have a null place.  Equal vectors share a place."""
    x = F.col(features).cast("array<double>")
    some = _usable(points, features).select(x.alias("x"), F.xxhash64(F.col(id_col), F.lit(7)).alias("h")).orderBy("h", "x").limit(landmarks).collect()
    known = np.array([r.x for r in some], dtype=float)
    if len(known):
        known = np.unique(known, axis=0)
        places = tsne(known, perplexity, iterations)
    schema = points.schema
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    at = points.columns.index(features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, BATCH):
                part = batch.slice(i, BATCH)
                rows = part.column(at).to_pylist()
                fine = [r for r, v in enumerate(rows) if v is not None and len(known) and all(a is not None and np.isfinite(a) for a in v)]
                found: list = [None] * len(rows)
                if fine:
                    far = squared_distances(np.array([rows[r] for r in fine], dtype=float), known)
                    k = min(nearest, len(known))
                    best = np.argpartition(far, k - 1, axis=1)[:, :k]
                    weight = 1.0 / (np.take_along_axis(far, best, 1) + 1e-9)
                    place = (weight[:, :, None] * places[best]).sum(1) / weight.sum(1)[:, None]
                    for r, p in zip(fine, place.tolist()):
                        found[r] = p
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found, pa.list_(pa.float64()))], names=[*part.schema.names, out])

    return points.mapInArrow(run, f"{kept}, `{out}` array<double>")


def trustworthiness(points: DataFrame, id_col: str, features: str, places: dict[str, str], *, queries: int = 200, k: int = 10) -> DataFrame:
    """(method, n, queries, trustworthiness) of several maps of the same rows: ``places`` names each map's column.

    The query rows are the ``queries`` ones with the smallest hash of their id, against all rows.  Ties in distance
    count as nearer only if strictly smaller; on the map they go to the smaller id."""
    rows = _usable(points, features).select(F.col(id_col).alias("id"), F.col(features).cast("array<double>").alias("x"),
                                            *[F.col(c).cast("array<double>").alias(f"y{i}") for i, c in enumerate(places.values())])
    asked = rows.withColumn("h", F.xxhash64("id", F.lit(11))).orderBy("h", "id").limit(queries).collect()
    names, n = list(places), rows.count()
    ids = [r.id for r in asked]
    own = {r.id: i for i, r in enumerate(asked)}
    feature = np.array([r.x for r in asked], dtype=float)
    maps = [np.array([r[f"y{i}"] for r in asked], dtype=float) for i in range(len(names))]
    id_type = rows.schema["id"].dataType.simpleString()

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The k rows of each batch that are nearest to each query on each map, with their distance in the feature space."""
        for batch in batches:
            for i in range(0, batch.num_rows, BATCH):
                part = batch.slice(i, BATCH)
                x, who = _vectors(part.column(1)), part.column(0).to_pylist()
                far = squared_distances(feature, x)
                order = np.argsort(np.argsort(np.array(who)))
                got = []
                for m in range(len(names)):
                    d = squared_distances(maps[m], _vectors(part.column(2 + m)))
                    for c, r in enumerate(who):
                        if r in own:
                            d[own[r], c] = np.inf
                    for q in range(len(ids)):
                        best = np.lexsort((order, d[q]))[:k]
                        got += [(m, q, who[c], float(d[q, c]), float(far[q, c])) for c in best if np.isfinite(d[q, c])]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*got), [pa.int32(), pa.int32(), part.schema.field(0).type, pa.float64(), pa.float64()])],
                                                 names=["m", "q", "id", "d", "far"]) if got else pa.RecordBatch.from_pylist([], pa.schema(
                    [("m", pa.int32()), ("q", pa.int32()), ("id", part.schema.field(0).type), ("d", pa.float64()), ("far", pa.float64())]))

    top = Window.partitionBy("m", "q").orderBy("d", "id")
    best = rows.mapInArrow(near, f"m int, q int, id {id_type}, d double, far double").withColumn("r", F.row_number().over(top)).where(F.col("r") <= k)
    wanted = best.select("m", "q", "id", "far").collect()  # maps x queries x k rows at most
    bounds = np.array([[r.far for r in wanted], [r.q for r in wanted]]) if wanted else np.zeros((2, 0))

    def nearer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(bounds.shape[1], np.int64)
        for batch in batches:
            for i in range(0, batch.num_rows, BATCH):
                part = batch.slice(i, BATCH)
                far = squared_distances(feature, _vectors(part.column(1)))
                for c, r in enumerate(part.column(0).to_pylist()):
                    if r in own:
                        far[own[r], c] = np.inf
                for at in range(0, len(total), BATCH):
                    q = bounds[1, at:at + BATCH].astype(int)
                    total[at:at + BATCH] += (far[q] < bounds[0, at:at + BATCH, None] - 1e-12).sum(1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["i", "n"])

    counted = rows.select("id", "x").mapInArrow(nearer, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).collect()
    lost = [0.0] * len(names)
    for r in counted:
        lost[wanted[r.i].m] += max(0, r.n + 1 - k)  # rank in the feature space, from 1
    scale = 2.0 / (len(ids) * k * max(2 * n - 3 * k - 1, 1)) if ids else 0.0
    from creatorlens.session import literal_frame
    return literal_frame(points.sparkSession, [(m, n, len(ids), 1.0 - scale * s) for m, s in zip(names, lost)],
                         "method string, n bigint, queries bigint, trustworthiness double")
