"""Principal components of wide sparse vectors against the full covariance, and on more features than MLlib's PCA takes."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from creatorlens.operators import cluster as clu


def _frame(spark, x):
    rows = [(i, Vectors.sparse(len(r), [(int(j), float(r[j])) for j in np.flatnonzero(r)]) if i % 3 else Vectors.dense(r)) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, ["id", "features"]).repartition(3)


def test_components_match_the_covariance(spark):
    r = np.random.default_rng(3)
    x = r.normal(size=(60, 40)) * (r.random((60, 40)) < 0.2) * np.linspace(3, 1, 40)
    df = _frame(spark, x)
    got = clu.sparse_components(df.select("features"), 3)
    values, vectors = np.linalg.eigh(np.cov(x.T))
    assert got.T @ got == pytest.approx(np.eye(3), abs=1e-9)
    assert np.abs((got * vectors[:, ::-1][:, :3]).sum(0)) == pytest.approx(np.ones(3), abs=1e-6)
    rows = clu.project_sparse(df, "features", got).orderBy("id").collect()
    assert np.array([r.projection for r in rows]) == pytest.approx(x @ got, abs=1e-9)


def test_a_variance_that_many_directions_share(spark):
    """Rows that share nothing: all variances but one are equal, and the components are two of their directions."""
    x = np.eye(30)
    got = clu.sparse_components(_frame(spark, x).select("features"), 2)
    c = np.cov(x.T)
    assert got.T @ got == pytest.approx(np.eye(2), abs=1e-9)
    assert c @ got == pytest.approx(got / 29, abs=1e-8)
    with pytest.raises(ValueError):
        clu.sparse_components(_frame(spark, x[:1]).select("features"), 2)


def test_titles_of_words_that_occur_once(spark):
    """More features than a covariance of all their pairs can be held for (MLlib's PCA refuses above 65535)."""
    titles = spark.range(34000).selectExpr("id", "concat('item w', id) AS title")
    out = clu.cluster_titles(titles, min_df=1.0, max_df=0.5)
    assert out.count() == 34000 and out.where("cluster NOT BETWEEN 0 AND 2 OR size(projection) <> 2").count() == 0
