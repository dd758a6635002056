"""Classifiers that are fitted side by side: against MLlib's own, and in how many jobs a grid is searched."""

import tempfile

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LinearSVC
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from creatorlens.operators import classify as cls
from creatorlens.operators import joint_svm as js
from creatorlens.operators.kernels import RandomFourierFeatures


def titles(spark, n=400, noise=0.15, seed=4):
    r = np.random.default_rng(seed)
    words, classes = [f"w{i}" for i in range(12)], ["a", "b", "c"]
    rows = []
    for i in range(n):
        own = r.choice(12, size=r.integers(1, 4), replace=False)
        label = classes[min(own) % 3] if r.random() > noise else classes[r.integers(3)]
        rows.append((i, " ".join(words[k] for k in own), label))
    return spark.createDataFrame(rows, "id long, title string, category string")


def vectors(spark, n=200, d=9, seed=1):
    r = np.random.default_rng(seed)
    x = np.where(r.random((n, d)) < 0.4, r.normal(1, 1, (n, d)), 0.0)
    x[:, -1] = 0.0  # a feature without deviation
    x[5] = 0.0
    y = (x @ r.normal(size=(d, 3)) + r.normal(0, 1.0, (n, 3))).argmax(1).astype(float)
    rows = [(float(c), Vectors.sparse(d, [(j, float(v)) for j, v in enumerate(row) if v])) for c, row in zip(y, x)]
    return spark.createDataFrame(rows, ["_label", "_unit"]).repartition(3).persist(), x, y


def loss(x, y, reg, weights, offset):
    return np.maximum(0, 1 - y * (x @ weights + offset)).mean() + reg / 2 * ((weights * x.std(0, ddof=1)) ** 2).sum()


def test_as_good_as_mllibs_classifiers(spark):
    rows, x, y = vectors(spark)
    regs = [0.5, 0.01]
    one, = js.fit_together(rows, [js.Kernel("linear", 9, 9)], 3, regs, max_iter=100, tol=1e-6)
    for r, reg in enumerate(regs):
        for c in range(3):
            theirs = LinearSVC(featuresCol="_unit", labelCol="y", regParam=reg, maxIter=40, tol=1e-5).fit(rows.coalesce(1).withColumn("y", (F.col("_label") == c).cast("double")))
            sign = np.where(y == c, 1.0, -1.0)
            best = loss(x, sign, reg, theirs.coefficients.toArray(), theirs.intercept)
            assert loss(x, sign, reg, one.weights[:, 3 * r + c], one.offsets[3 * r + c]) <= best * 1.01
    scores = x @ one.weights + one.offsets
    want = [(scores[:, 3 * r:3 * r + 3].argmax(1) == y).mean() for r in range(2)]
    assert js.shares(rows, [one], 3) == [pytest.approx(want)] and js.shares(rows.limit(0), [one], 3) == [[0.0, 0.0]]


def test_random_features_are_those_of_the_pipeline(spark):
    rows, x, y = vectors(spark)
    model = RandomFourierFeatures(inputCol="_unit", outputCol="_features", kernel="rbf").fit(rows)
    z = np.array([r[0].toArray() for r in model.transform(rows.coalesce(1)).select("_features").collect()])
    start = np.concatenate([[0], np.cumsum((x != 0).sum(1))])
    sparse = js.Sparse(start, np.nonzero(x)[1], x[x != 0], 9)
    ours = js._features(sparse, model.kernel_map())
    assert np.allclose(sorted(map(tuple, z.round(9))), sorted(map(tuple, ours.x.round(9))))
    some = np.random.default_rng(0).normal(size=(200, 4))
    assert np.allclose(sparse.back(some), x.T @ some) and np.allclose(sparse.squares(), (x ** 2).sum(0))


def test_grid_search_takes_few_jobs(spark):
    """A pass answers for all kernels, constants and classes of a fold: 184 jobs here, 2,851 when each
    classifier was fitted by itself.  C reaches the classifiers, so the scores differ with it."""
    train = titles(spark)
    jobs = spark.sparkContext._jsc.sc().dagScheduler().numTotalJobs
    before = jobs()
    model, scores = cls.grid_search(train)
    assert jobs() - before < 500
    assert [s[:2] for s in scores] == [(k, c) for k in ("linear", "rbf") for c in (0.1, 1.0, 10.0)]
    assert all(0.6 < a <= 1 for *_, a in scores) and all(len({a for k, _, a in scores if k == kernel}) > 1 for kernel in ("linear", "rbf"))
    got = cls.predict(model, train).collect()
    assert np.mean([r.prediction == r.category for r in got]) > 0.75
    assert not [i for i in spark.sparkContext._jsc.getPersistentRDDs()]


def test_joint_model_is_a_pipeline_model(spark):
    train = titles(spark)
    path = tempfile.mkdtemp(prefix="cl-model-") + "/ovr"
    model = cls.fit_svm(train, solver="joint")
    assert isinstance(model, PipelineModel) and len(model.stages[-1].models) == 4
    model.stages[-1].save(path)
    ours = {r.id: r.prediction for r in cls.predict(model, train).collect()}
    names = model.stages[0].labels
    theirs = {r.id: names[int(r._pred)] for r in model.transform(train).collect()}
    assert ours == theirs
    plain = {r.id: r.prediction for r in cls.predict(cls.fit_svm(train), train).collect()}
    assert np.mean([plain[k] == v for k, v in ours.items()]) > 0.95


def test_sums_of_many_tasks_are_added_by_tasks(spark, monkeypatch):
    rows, x, y = vectors(spark)
    monkeypatch.setattr(js, "DIRECT", 1)
    monkeypatch.setattr(js, "STRETCH", 7)
    (n,), total = js.totals(rows, 9, lambda label, x: [np.array([len(label)]), x.back(np.ones((len(label), 1)))])
    assert n == 200 and np.allclose(total[:, 0], x.sum(0))
