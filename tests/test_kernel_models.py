import numpy as np
import pytest

from creatorlens.operators import cluster, kernel_svm, neighbour_map as nm


def blobs(seed=1, n=240, classes=3, d=5, noise=1.1):
    r = np.random.default_rng(seed)
    centres = r.normal(0, 2, (classes, d))
    label = np.arange(n) % classes
    return centres[label] + r.normal(0, noise, (n, d)), [f"c{k}" for k in label]


def frame(spark, x, labels, parts=5):
    return spark.createDataFrame([(i, lab, v) for i, (lab, v) in enumerate(zip(labels, x.tolist()))], "id long, label string, x array<double>").repartition(parts)


def dual_by_projection(kernel, y, c, steps=60_000):
    """An independent solver: projected gradient on the box and the hyperplane."""
    alpha = np.full(len(y), 0.0)
    q = kernel * np.outer(y, y)
    rate = 1.0 / np.linalg.eigvalsh(q)[-1]
    for _ in range(steps):
        move = alpha + rate * (1.0 - q @ alpha)
        low, high = -1e3, 1e3
        for _ in range(60):
            mid = (low + high) / 2
            if (y * np.clip(move - mid * y, 0, c)).sum() > 0:
                low = mid
            else:
                high = mid
        new = np.clip(move - mid * y, 0, c)
        if np.abs(new - alpha).max() < 1e-9:
            break
        alpha = new
    return alpha


def test_dual_solver_against_projected_gradient():
    x, labels = blobs(2, 80, 2, noise=2.0)
    y = np.where(np.array(labels) == "c0", 1.0, -1.0)
    kernel = kernel_svm.rbf(x, x, 0.2)
    objective = lambda a: a.sum() - 0.5 * (a * y) @ kernel @ (a * y)
    ours = kernel_svm.solve_dual(kernel, y, 1.0, 1e-6)
    other = dual_by_projection(kernel, y, 1.0)
    assert abs((ours * y).sum()) < 1e-9 and ours.min() >= 0 and ours.max() <= 1.0 + 1e-12
    assert objective(ours) == pytest.approx(objective(other), rel=1e-5) and objective(ours) >= objective(other) - 1e-6


def test_cascade_equals_one_dual_over_all_rows(spark):
    x, labels = blobs()
    model = kernel_svm.fit_kernel_svm(frame(spark, x, labels), "label", "x", "id", part=30, tol=1e-4)
    assert model.gap <= 1e-4 and model.rounds > 1 and model.classes == ["c0", "c1", "c2"]
    for pair in model.pairs:
        own = np.array([i for i, k in enumerate(labels) if k in (pair.first, pair.second)])
        y = np.where(np.array(labels)[own] == pair.first, 1.0, -1.0)
        kernel = kernel_svm.rbf(x[own], x[own], model.gamma)
        alpha = kernel_svm.solve_dual(kernel, y, 1.0, 1e-6)
        value = y - kernel @ (alpha * y)
        free = (alpha > 1e-6) & (alpha < 1 - 1e-6)
        brute = kernel @ (alpha * y) + value[free].mean()
        assert np.abs(brute - pair.decide(x[own], model.gamma)).max() < 5e-3
        assert ((brute > 0) == (pair.decide(x[own], model.gamma) > 0))[np.abs(brute) > 5e-3].all()
    got = kernel_svm.predict_kernel_svm(model, frame(spark, x, labels), "x").collect()
    assert np.mean([r.label == r.prediction for r in got]) > 0.85


def test_votes_and_edges(spark):
    one = kernel_svm.fit_kernel_svm(frame(spark, np.ones((5, 2)), ["a"] * 5), "label", "x", "id")
    assert one.votes(np.zeros((2, 2))) == ["a", "a"] and one.gap == 0.0
    df = spark.createDataFrame([(1, "a", [0.0, 1.0]), (2, "b", [1.0, 0.0]), (3, None, [1.0, 1.0]), (4, "a", None), (5, "a", [0.0, 1.0]), (6, "b", [0.0, 1.0])],
                               "id long, label string, x array<double>")
    model = kernel_svm.fit_kernel_svm(df, "label", "x", "id")
    got = {r.id: r.prediction for r in kernel_svm.predict_kernel_svm(model, df, "x").collect()}
    assert got[1] == got[5] == got[6] == "a" and got[2] == "b" and got[4] is None
    empty = kernel_svm.fit_kernel_svm(df.limit(0), "label", "x", "id")
    assert empty.votes(np.zeros((1, 2))) == [None]


def brute_trust(x, y, queries, k):
    far, d = nm.squared_distances(x, x), nm.squared_distances(y, y)
    np.fill_diagonal(far, np.inf)
    np.fill_diagonal(d, np.inf)
    lost = 0
    for q in queries:
        near = np.lexsort((np.arange(len(x)), d[q]))[:k]
        lost += sum(max(0, (far[q] < far[q, j] - 1e-12).sum() + 1 - k) for j in near)
    n = len(x)
    return 1 - 2 / (len(queries) * k * (2 * n - 3 * k - 1)) * lost


def test_map_and_trustworthiness(spark):
    x, labels = blobs(3, 400, 8, 12)
    df = frame(spark, x, labels).withColumnRenamed("x", "features")
    placed = nm.neighbour_map(cluster.project(df, out="pca"), landmarks=150, iterations=250).cache()
    rows = sorted(placed.collect(), key=lambda r: r.id)
    assert len(rows) == 400 and all(len(r.projection) == 2 and np.isfinite(r.projection).all() for r in rows)
    got = {r.method: r for r in nm.trustworthiness(placed, "id", "features", {"t-SNE": "projection", "PCA": "pca"}, queries=400, k=7).collect()}
    for method, column in (("t-SNE", "projection"), ("PCA", "pca")):
        want = brute_trust(np.array([r.features for r in rows]), np.array([r[column] for r in rows]), range(400), 7)
        assert got[method].trustworthiness == pytest.approx(want, abs=1e-9) and got[method].n == got[method].queries == 400
    assert got["t-SNE"].trustworthiness > got["PCA"].trustworthiness + 0.02


def test_map_of_odd_rows(spark):
    rows = [(1, [1.0, 2.0]), (2, None), (3, [float("nan"), 1.0]), (4, [1.0, 2.0]), (5, [3.0, 1.0]), (6, [None, 1.0])]
    df = spark.createDataFrame(rows, "id long, features array<double>")
    got = {r.id: r.projection for r in nm.neighbour_map(df, iterations=10).collect()}
    assert got[2] is got[3] is got[6] is None and got[1] == got[4] != got[5]
    assert nm.neighbour_map(df.limit(0)).collect() == []


def test_perplexity_of_probabilities():
    x, _ = blobs(5, 100)
    p = nm.neighbour_probabilities(x, 20.0)
    assert p.sum() == pytest.approx(1.0, abs=1e-6) and np.allclose(p, p.T)
