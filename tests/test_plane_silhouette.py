import math

import numpy as np
import pytest

from creatorlens.operators import plane_silhouette as ps

SCHEMA = "id long, cluster string, features array<double>, x string"


def brute(rows):
    ok = [r for r in rows if r[1] is not None and r[2] and all(v is not None and math.isfinite(v) for v in r[2])]
    p, c = np.array([r[2] for r in ok]), np.array([r[1] for r in ok])
    out = {}
    for (i, own, here, _), at in zip(ok, p):
        d = np.hypot(*(p - at).T)
        means = {k: d[c == k].sum() / max((c == k).sum() - (k == own), 1) for k in set(c)}
        a, b = means.pop(own), min(means.values(), default=math.nan)
        s = 0.0 if (c == own).sum() == 1 or not means or max(a, b) == 0 else (b - a) / max(a, b)
        out.setdefault((i, own, tuple(here)), s)
    return out


def sample(n=600, hot=150):
    r = np.random.default_rng(5)
    rows = []
    for i in range(n):
        k = int(r.integers(0, 4))
        at = r.normal([k * 3.0, (k % 2) * 4.0], [1.0, 0.3 + k])
        rows.append((i, f"c{k}", [float(v) for v in at], "e"))
    rows += [(n + i, "c1", [3.0, 4.0], "e") for i in range(hot)]  # one hot place
    rows += [(n + hot + i, "c2", [float(v) for v in r.normal(6.0, 0.001, 2)], "e") for i in range(hot)]  # one hot cell
    rows += [(5000, "alone", [100.0, -50.0], "e"), (5000, "c0", [0.0, 0.0], "e"), (None, "c0", [0.0, 0.1], "e")]
    return rows


BAD = [(9001, None, [1.0, 1.0], "e"), (9002, "c0", None, "e"), (9003, "c0", [1.0], "e"), (9004, "c0", [math.nan, 1.0], "e"), (9005, "c0", [math.inf, 1.0], "e"),
       (9006, "c0", [None, 1.0], "e")]


@pytest.mark.parametrize("near", [0, 64, 10_000])
def test_intervals_hold_the_silhouette_of_all_pairs(spark, near):
    rows = sample()
    df = spark.createDataFrame(rows + BAD, SCHEMA)
    got = ps.plane_silhouette(df.withColumn("silhouette", df.id), near=near).collect()
    want = brute(rows)
    by_id = {(i, c): s for (i, c, _), s in want.items()}
    assert len(got) == len(rows) + len(BAD)
    for r in got:
        if r.id and r.id > 9000:
            assert r.silhouette is None and r.low is None and r.high is None
            continue
        s = by_id[(r.id, r.cluster)]
        assert r.low - 1e-9 <= s <= r.high + 1e-9 and r.low <= r.silhouette <= r.high
    widths = [r.high - r.low for r in got if r.low is not None]
    errors = [abs(r.silhouette - by_id[(r.id, r.cluster)]) for r in got if r.low is not None]
    assert np.mean(widths) < 0.05 and np.mean(errors) < 0.005


def test_no_points_one_cluster_one_place(spark):
    assert ps.plane_silhouette(spark.createDataFrame([], SCHEMA)).collect() == []
    assert [r.silhouette for r in ps.plane_silhouette(spark.createDataFrame(BAD, SCHEMA)).collect()] == [None] * len(BAD)
    one = spark.createDataFrame([(i, "a", [float(i), 2.0], "") for i in range(5)], SCHEMA)
    assert [r.silhouette for r in ps.plane_silhouette(one).collect()] == [0.0] * 5
    same = spark.createDataFrame([(i, "ab"[i % 2], [1.0, 2.0], "") for i in range(6)], SCHEMA)
    assert [r.silhouette for r in ps.plane_silhouette(same).collect()] == [0.0] * 6


def test_sums_of_the_tree_are_those_of_the_points():
    import pyarrow as pa
    r = np.random.default_rng(2)
    p, depth, side = r.random((300, 2)) * 8.0, 3, 8.0
    cells = np.floor(p).astype(int)
    middle = p - cells - 0.5
    leaves = {}
    for (i, j), (dx, dy) in zip(cells, middle):
        leaves.setdefault((i, j), []).append((1, dx, dy, dx * dx + dy * dy))
    table = pa.table({"c": [0] * len(leaves), "i": [i for i, _ in leaves], "j": [j for _, j in leaves],
                      **{name: [float(np.sum([v[a] for v in vs])) for vs in leaves.values()] for a, name in enumerate(("n", "sx", "sy", "sq"))}})
    for level, of in enumerate(ps._tree(table, 1, depth, (0.0, 0.0), side)):
        width = side / (1 << level)
        for i in range(1 << level):
            for j in range(1 << level):
                own = p[(np.floor(p / width) == (i, j)).all(1)]
                assert of["n"][0, i, j] == len(own)
                if len(own):
                    g = own.mean(0)
                    assert np.allclose((of["x"][0, i, j], of["y"][0, i, j]), g) and np.isclose(of["spread"][0, i, j], ((own - g) ** 2).sum(1).mean())
