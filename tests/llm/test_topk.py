import math
import random

import numpy as np
from pyspark.sql import functions as F

from creatorlens.llm import topk


def brute(rows, asked, k):
    ok = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in dict.fromkeys((i, tuple(v)) for i, v in ok if i is not None and asked(i)):
        scores = sorted(((-sum(a * b for a, b in zip(q, v)), j is None, j or 0) for j, v in ok if j != i))
        out += [(i, n + 1, None if none else j, -s) for n, (s, none, j) in enumerate(scores[:k])]
    return out


def _rows(n, seed, dims=8):
    r = random.Random(seed)
    hot = [r.gauss(0, 1) for _ in range(dims)]
    rows = [(i, hot if i % 3 == 0 else [round(r.gauss(0, 0.3), 1) for _ in range(dims)]) for i in range(n)]
    return rows + [(n, None), (n + 1, [None] * dims), (n + 2, [float("nan")] * dims), (n + 3, [float("inf")] + [0.0] * (dims - 1)), (None, hot), (None, hot),
                   (n + 4, []), (n + 5, [1.0]), (5, hot), (20, [0.5] * dims), (20, [0.5] * dims), (40, [0.0] * dims)]


def _check(spark, rows, k, asked=20):
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, id long, v long")
    got = [tuple(r)[:4] for r in topk.top_k(df, F.col("id") % asked == 0, k).collect()]
    assert sorted(got, key=repr) == sorted(brute(rows, lambda i: i % asked == 0, k), key=repr)


def test_against_brute_force(spark):
    _check(spark, _rows(300, 1), 20)


def test_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 50)
    monkeypatch.setattr(topk, "SAMPLE", 30)
    _check(spark, _rows(400, 2), 10)
    _check(spark, _rows(12, 3), 20)


def test_large_components(spark):
    r = random.Random(4)
    _check(spark, [(i, [float(r.randint(-2**24, 2**24)) for _ in range(3)]) for i in range(60)], 5)


def test_query_of_the_given_table(spark):
    """The registered query, whose plan drops a column."""
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding").collect()
    got = [tuple(r) for r in topk.op2_topk(spark, "/root/testdata/sf0.001").collect()]
    assert sorted(got) == sorted(brute([tuple(r) for r in rows], lambda i: i % 20 == 0, 20))


def test_empty(spark):
    for rows in ([], [(1, [1.0])], [(20, [1.0])], [(20, None)]):
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        assert topk.top_k(df, F.col("id") % 20 == 0, 3).collect() == []


def test_stops_early():
    """Clustered candidates far from the queries are never evaluated."""
    import pyarrow as pa
    r = np.random.default_rng(1)
    x = np.floor(np.concatenate([r.normal(0, 5, (2000, 16)) + 200 * np.eye(16)[c] for c in range(4)]))
    pivots = topk.choose_pivots(x[::100], 16)
    block = topk.Eliminator(pa.array(range(len(x))), x, topk.pivot_distances(x, pivots), 10)
    q = x[:5]
    query, candidate, score, evaluated = block.search(np.arange(5), q, topk.pivot_distances(q, pivots), np.full(5, -np.inf))
    assert evaluated.sum() < 5 * len(x) / 2
    for i in range(5):
        full = sorted(((-int(s), j) for j, s in enumerate(x @ q[i]) if j != i))[:10]
        assert [(-int(s), int(c)) for a, c, s in zip(query, candidate, score) if a == i] == full


def test_eliminates_on_the_given_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    n = rows.count()
    share = (topk.top_k(rows, F.col("id") % 20 == 0, 20).groupBy("query_id").agg(F.first("evaluated").alias("e")).agg(F.avg("e")).first()[0]) / (n - 1)
    print(f"evaluated share {share:.3f} of {n} rows")
    assert share < 0.8
