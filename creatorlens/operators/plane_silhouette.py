"""Silhouette with Euclidean distances of points in the plane (A17), without forming pairs of points.

The sum of the distances from a point to a cluster is taken over the cells of a quadtree.  A cell far from the
point counts as its members at their centroid g; the true mean distance lies between |p - g| and
|p - g| + min(sqrt(V), V / (2 * gap)), where V is the members' mean squared distance from g and gap the distance from p
to the cell (Jensen's inequality, and the second derivative of a distance being at most 1 / distance).  The smallest cells
around the point are summed place by place if they hold few places, else bounded in the same way.  So every point gets
its silhouette with a proven interval.

The tree has a fixed largest size (``CELLS`` sums), so it travels with the tasks; the places of the cells around a
point, at most 9 * ``near`` of them, come by a join on the cell.  Points at one place are one place with a count.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creatorlens.session import materialize

CELLS = 1 << 18  # sums of (cluster, smallest cell) at most
DEEPEST, NEAR, SALTS = 8, 64, 8
BLOCK = 1 << 20  # distances computed together


def _tree(leaves: pa.Table, k: int, depth: int, low: tuple[float, float], side: float) -> list[dict]:
    """Per level the count, centroid and spread of each (cluster, cell)."""
    width = side / (1 << depth)
    at = tuple(leaves.column(c).to_numpy() for c in ("c", "i", "j"))
    n, sx, sy, sq = (np.zeros((k, 1 << depth, 1 << depth)) for _ in range(4))
    for array, name in ((n, "n"), (sx, "sx"), (sy, "sy"), (sq, "sq")):  # about the middle of the cell
        array[at] = leaves.column(name).to_numpy()
    levels = []
    for level in range(depth, -1, -1):
        with np.errstate(invalid="ignore", divide="ignore"):
            mx, my = np.nan_to_num(sx / n), np.nan_to_num(sy / n)
            spread = np.maximum(np.nan_to_num(sq / n) - mx * mx - my * my, 0.0)
        middle = (np.arange(1 << level) + 0.5) * width
        levels.append({"n": n, "x": low[0] + middle[:, None] + mx, "y": low[1] + middle + my, "spread": spread, "width": width})
        if not level:
            break
        # move the sums to the middle of the parent, half a cell away, and add the four children
        half = width / 2
        dx = np.where(np.arange(1 << level) % 2, half, -half)[:, None]
        dy = np.where(np.arange(1 << level) % 2, half, -half)
        sq = sq + 2 * (sx * dx + sy * dy) + n * (dx * dx + dy * dy)
        sx, sy = sx + n * dx, sy + n * dy
        n, sx, sy, sq = (a.reshape(k, 1 << (level - 1), 2, 1 << (level - 1), 2).sum((2, 4)) for a in (n, sx, sy, sq))
        width *= 2
    return levels[::-1]


def _around(i: int, j: int, level: int) -> set[tuple[int, int]]:
    size = 1 << level
    return {(a, b) for a in range(max(i - 1, 0), min(i + 2, size)) for b in range(max(j - 1, 0), min(j + 2, size))}


def _met(i: int, j: int, depth: int, summed: np.ndarray) -> list[tuple[int, list[tuple[int, int]]]]:
    """(level, cells) whose sums a point of the smallest cell (i, j) uses: at each level the cells that are not
    beside its own but whose parents are beside its parent; of the smallest cells beside it those not summed by place."""
    out = []
    for level in range(1, depth + 1):
        up = depth - level
        beside = _around(i >> up, j >> up, level)
        below = {(2 * a + s, 2 * b + t) for a, b in _around(i >> (up + 1), j >> (up + 1), level - 1) for s in (0, 1) for t in (0, 1)}
        cells = below - beside
        if level == depth:
            cells |= {c for c in beside if not summed[c]}
        if cells:
            out.append((level, sorted(cells)))
    return out


def plane_silhouette(points: DataFrame, id_col: str = "id", cluster: str = "cluster", features: str = "features",
                     near: int = NEAR) -> DataFrame:
    """``id_col, cluster, silhouette, low, high``: the silhouette of every point and the interval that is sure to hold it.

    ``features`` holds the two coordinates.  A cluster of one point has silhouette 0, and so have all points if there is
    one cluster only; rows with a null cluster, or coordinates null or not finite, get nulls and count nowhere.  Ids may
    repeat or be null.  At most ``CELLS / 16`` clusters."""
    xy = F.col(features).cast("array<double>")
    rows = points.select(F.col(id_col).alias("id"), F.col(cluster).alias("cluster"), F.get(xy, F.lit(0)).alias("x"), F.get(xy, F.lit(1)).alias("y"))
    finite = [F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(math.inf)) for c in "xy"]
    rows = rows.withColumn("known", F.col("cluster").isNotNull() & finite[0] & finite[1])
    known = rows.filter("known")
    sizes = known.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in "xy"])
    sizes = sizes.orderBy("cluster").limit(CELLS // 16 + 1).collect()
    if len(sizes) > CELLS // 16:
        raise ValueError(f"more than {CELLS // 16} clusters")
    if not sizes:
        return rows.select(F.col("id").alias(id_col), "cluster", *[F.lit(None).cast("double").alias(c) for c in ("silhouette", "low", "high")])
    k, total = len(sizes), np.array([r.n for r in sizes], float)
    low = tuple(min(r[f"min_{c}"] for r in sizes) for c in "xy")
    side = max(max(r[f"max_{c}"] for r in sizes) - start for c, start in zip("xy", low)) * (1 + 1e-9) or 1.0
    depth = min(DEEPEST, int(math.log(CELLS / k, 4)))
    width = side / (1 << depth)

    def cell(c: str, start: float):
        return F.least(F.floor((F.col(c) - start) / width), F.lit((1 << depth) - 1)).cast("int")

    number = points.sparkSession.createDataFrame([(r.cluster, c) for c, r in enumerate(sizes)], rows.select("cluster", F.lit(0).alias("c")).schema)
    rows = rows.join(F.broadcast(number), "cluster", "left")  # at most CELLS / 16 rows
    rows = rows.withColumns({"c": F.when(F.col("known"), F.col("c")), "i": F.when(F.col("known"), cell("x", low[0])),
                             "j": F.when(F.col("known"), cell("y", low[1]))})
    places = materialize(rows.filter("known").groupBy("c", "i", "j", "x", "y").agg(F.count(F.lit(1)).alias("n")))
    dx, dy = (F.col(c) - low[a] - (F.col(g) + 0.5) * width for a, (c, g) in enumerate(zip("xy", "ij")))
    leaves = places.groupBy("c", "i", "j").agg(F.sum("n").alias("n"), F.sum(F.col("n") * dx).alias("sx"), F.sum(F.col("n") * dy).alias("sy"),
                                               F.sum(F.col("n") * (dx * dx + dy * dy)).alias("sq"), F.count(F.lit(1)).alias("places")).toArrow()
    tree = _tree(leaves, k, depth, low, side)  # at most CELLS rows
    held = np.zeros((1 << depth, 1 << depth), np.int64)
    np.add.at(held, tuple(leaves.column(c).to_numpy() for c in "ij"), leaves.column("places").to_numpy())
    summed = held <= near

    few = places.groupBy("i", "j").agg(F.count(F.lit(1)).alias("held")).filter(F.col("held") <= near).drop("held")
    step = F.explode(F.array(*map(F.lit, (-1, 0, 1))))
    beside = (places.join(few, ["i", "j"]).withColumn("s", step).withColumn("t", step)
              .groupBy((F.col("i") + F.col("s")).alias("i"), (F.col("j") + F.col("t")).alias("j"))
              .agg(F.collect_list(F.struct("c", "x", "y", "n")).alias("near")))  # at most 9 * near places
    far = F.transform("near", lambda p: F.struct(p["c"].alias("c"), (p["n"] * F.sqrt((p["x"] - F.col("x")) ** 2 + (p["y"] - F.col("y")) ** 2)).alias("d")))
    # a cell with many points meets its places in SALTS parts
    beside = beside.withColumn("salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
    rows = rows.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    joined = rows.join(beside, ["i", "j", "salt"], "left").select("id", "cluster", "c", "i", "j", "x", "y", far.alias("near"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        @lru_cache(4096)
        def sums(i: int, j: int):
            """Counts, centroids and spreads (k rows) of the cells met, and the cells' bounds."""
            parts, bounds = [], []
            for level, cells in _met(i, j, depth, summed):
                at, of = tuple(np.array(cells).T), tree[level]
                parts.append([of[c][(slice(None), *at)] for c in ("n", "x", "y", "spread")])
                bounds.append([low[0] + at[0] * of["width"], low[1] + at[1] * of["width"], np.full(len(cells), of["width"])])
            if not parts:
                return None
            return [np.concatenate(a, axis=1) for a in zip(*parts)], [np.concatenate(a) for a in zip(*bounds)]

        for batch in batches:
            rows = len(batch)
            at, least, slack = np.arange(rows), np.zeros((rows, k)), np.zeros((rows, k))
            own, i, j = (batch.column(c).fill_null(-1).to_numpy() for c in ("c", "i", "j"))
            x, y = (batch.column(c).to_numpy(zero_copy_only=False) for c in "xy")
            near_sums = batch.column("near")
            flat, counts = near_sums.flatten(), near_sums.value_lengths().fill_null(0).to_numpy()
            np.add.at(least, (np.repeat(at, counts), flat.field("c").to_numpy()), flat.field("d").to_numpy())
            ok = at[own >= 0]
            homes = i[ok].astype(np.int64) << 32 | j[ok]
            order = ok[np.argsort(homes, kind="stable")]
            for home in np.split(order, np.flatnonzero(np.diff(np.sort(homes))) + 1) if len(order) else []:
                found = sums(int(i[home[0]]), int(j[home[0]]))
                if found is None:
                    continue
                (n, gx, gy, spread), (x0, y0, w) = found
                most = max(BLOCK // n.size, 1)
                for some in (home[a:a + most] for a in range(0, len(home), most)):
                    px, py = x[some, None], y[some, None]
                    gap = np.hypot(np.maximum(np.maximum(x0 - px, px - x0 - w), 0), np.maximum(np.maximum(y0 - py, py - y0 - w), 0))[:, None]
                    with np.errstate(divide="ignore", invalid="ignore"):
                        bound = np.fmin(np.sqrt(spread), spread / (2 * gap))
                    least[some] += (n * np.hypot(gx - px[:, None], gy - py[:, None])).sum(2)
                    slack[some] += (n * bound).sum(2)
            found = np.full((3, rows), np.nan)
            alone = total[own[ok]] <= 1
            mine = np.zeros((len(ok), k), bool)
            mine[np.arange(len(ok)), own[ok]] = True
            for out, (a_share, b_share) in enumerate(((0.5, 0.5), (1, 0), (0, 1))):  # middle, lowest, highest
                a = (least[ok] + a_share * slack[ok])[mine] / np.maximum(total[own[ok]] - 1, 1)
                b = np.where(mine, np.inf, (least[ok] + b_share * slack[ok]) / total).min(1)
                with np.errstate(divide="ignore", invalid="ignore"):
                    s = (b - a) / np.maximum(a, b)
                found[out, ok] = np.where(alone | ~np.isfinite(s), 0.0, s)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("cluster"), *(pa.array(f, mask=own < 0) for f in found)],
                                             names=["id", "cluster", "silhouette", "low", "high"])

    types = {f.name: f.dataType.simpleString() for f in joined.schema}
    out = joined.mapInArrow(run, f"id {types['id']}, cluster {types['cluster']}, silhouette double, low double, high double")
    return out.select(F.col("id").alias(id_col), "cluster", "silhouette", "low", "high")
