"""Clustering and its evaluation.

Silhouette (A17) uses the squared-Euclidean closed form: for a point x and a
cluster C with n_C points, vector sum S_C and sum of squared norms Q_C,

    mean_{y in C} ||x - y||^2 = (n_C ||x||^2 - 2 x.S_C + Q_C) / n_C

(own cluster: divide by n_C - 1, the point itself adds 0).  The per-cluster
statistics are one aggregate with MLlib's vector summariser (a huge cluster is
just more partial rows); the k statistics rows travel as one scalar-subquery
value, and every point is scored in place - no pair of points is ever formed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from creatorlens import lexicons as L
from creatorlens.operators.ordered import running_sums
from creatorlens.session import materialize


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, v: acc + v)


def cluster_stats(points: DataFrame, cluster: str = "cluster", features: str = "features") -> DataFrame:
    """Per cluster: ``n``, ``s`` (vector sum, array<double>), ``q`` (sum of squared norms),
    by one aggregate with MLlib's vector summariser."""
    x = F.col(features).cast("array<double>")
    base = points.select(F.col(cluster).alias("cluster"), array_to_vector(x).alias("_v"), _dot(x, x).alias("_xx"))
    sums = base.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), Summarizer.sum(F.col("_v")).alias("_s"), F.sum("_xx").alias("q"))
    return sums.select("cluster", "n", vector_to_array("_s").alias("s"), "q")


def silhouette(points: DataFrame, id_col: str = "id", cluster: str = "cluster",
               features: str = "features") -> DataFrame:
    """Per-point silhouette (squared Euclidean); singleton cluster -> 0.
    Output ``id_col, cluster, silhouette``.

    Every point meets the statistics of all k clusters, one array that Spark
    ships once per plan; k is the clustering's own parameter and has no limit here."""
    stats = cluster_stats(points, cluster, features)
    st = stats.agg(F.collect_list(F.struct("cluster", "n", "s", "q"))).scalar()
    x = F.col(features).cast("array<double>")
    staged = points.select(F.col(id_col), F.col(cluster).alias("cluster"), x.alias("_x"), st.alias("_st"))
    xx = _dot(F.col("_x"), F.col("_x"))
    own = F.col("cluster")

    def mean_sq(c):
        return (c["n"] * F.col("_xx") - 2.0 * _dot(F.col("_x"), c["s"]) + c["q"])

    scored = staged.select(id_col, "cluster", "_x", "_st", xx.alias("_xx")).select(
        id_col, "cluster",
        F.transform("_st", lambda c: F.struct(
            (c["cluster"] == own).alias("own"), c["n"].alias("n"), mean_sq(c).alias("ss"))).alias("_d"))
    own_d = F.filter("_d", lambda d: d["own"])[0]
    others = F.filter("_d", lambda d: ~d["own"])
    a = F.when(own_d["n"] > 1, own_d["ss"] / (own_d["n"] - 1))
    b = F.array_min(F.transform(others, lambda d: d["ss"] / d["n"]))
    s = F.when(own_d["n"] <= 1, F.lit(0.0)).otherwise(F.try_divide(b - a, F.greatest(a, b)))
    return scored.select(id_col, "cluster", F.coalesce(s, F.lit(0.0)).alias("silhouette"))


def silhouette_summary(sil: DataFrame) -> DataFrame:
    """A17 mean plus per-cluster mean and size."""
    return sil.groupBy("cluster").agg(F.avg("silhouette").alias("mean_silhouette"), F.count(F.lit(1)).alias("n"))


def cluster_membership(assigned: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Cluster sizes and the number of distinct clusters."""
    sizes = assigned.groupBy(F.col(cluster).alias("cluster")).agg(F.count(F.lit(1)).alias("n"))
    k = sizes.agg(F.count(F.lit(1))).scalar()
    return sizes.select("cluster", "n", k.alias("n_clusters"))


def sorted_within_cluster(sil: DataFrame, id_col: str = "id") -> DataFrame:
    """Silhouette values ranked inside each cluster (ascending, ``id`` breaks ties).

    A row number per cluster is a running count; computing it over
    silhouette-quantile buckets keeps a dominant cluster from landing in a
    single task (``ordered.running_sums``)."""
    one = materialize(sil).withColumn("_one", F.lit(1))     # scanned three times below
    ranked = running_sums(one, "silhouette", ["_one"], partition_by=["cluster"], tiebreak=[id_col])
    return ranked.select(*sil.columns, F.col("cum__one").cast("int").alias("rank"))


def pca_model(vectors: DataFrame, k: int = 2):
    """M2: the fitted components over the vector column ``_vec``."""
    return PCA(k=k, inputCol="_vec", outputCol="_pca").fit(vectors)


def project(points: DataFrame, features: str = "features", k: int = 2, out: str = "projection") -> DataFrame:
    """M2: PCA to ``k`` dimensions (replaces the single-machine t-SNE)."""
    v = points.withColumn("_vec", array_to_vector(F.col(features).cast("array<double>")))
    model = pca_model(v, k)
    return model.transform(v).withColumn(out, vector_to_array("_pca")).drop("_vec", "_pca")


def kmeans(points: DataFrame, features: str = "features", k: int = L.KMEANS_K, seed: int = L.KMEANS_SEED,
           out: str = "cluster") -> DataFrame:
    """M1: k-means (k-means|| initialisation, fixed seed)."""
    return kmeans_with_centres(points, features, k, seed, out)[0]


def kmeans_with_centres(points: DataFrame, features: str = "features", k: int = L.KMEANS_K, seed: int = L.KMEANS_SEED,
                        out: str = "cluster") -> tuple[DataFrame, list[list[float]]]:
    """M1 with the k centres."""
    v = points.withColumn("_vec", array_to_vector(F.col(features).cast("array<double>")))
    model = KMeans(k=k, seed=seed, featuresCol="_vec", predictionCol=out).fit(v)
    return model.transform(v).drop("_vec"), [c.tolist() for c in model.clusterCenters()]


BLOCK, KRYLOV_STEPS, MOST_STEPS = 4, 5, 1000


def _entries(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, index, value) of every stored entry in an Arrow column of MLlib vectors, dense or sparse."""
    column = column.storage if isinstance(column, pa.ExtensionArray) else column
    kind, indices, values = (column.field(i) for i in (0, 2, 3))
    counts = pc.fill_null(pc.list_value_length(values), 0).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(counts)), counts)
    index = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    sparse = (kind.to_numpy(zero_copy_only=False) == 0)[row]
    index[sparse] = indices.flatten().to_numpy(zero_copy_only=False)
    return row, index, values.flatten().to_numpy(zero_copy_only=False)


def _products(row: np.ndarray, index: np.ndarray, value: np.ndarray, rows: int, v: np.ndarray) -> np.ndarray:
    """X v for the rows of one batch."""
    return np.stack([np.bincount(row, value * v[index, j], rows) for j in range(v.shape[1])], axis=1)


def _scatter(vectors: DataFrame, size: int, width: int, scores: Callable[..., np.ndarray]) -> np.ndarray:
    """X' S (size x width) for a column of vectors, one per row of X; ``scores(row, index, value, rows)`` gives the rows
    of S for a batch.  Tasks hand on one row per index that they hold, and Spark adds them up."""
    names = [f"s{j}" for j in range(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, index, value = _entries(batch.column(0))
            s = scores(row, index, value, batch.num_rows)
            held, at = np.unique(index, return_inverse=True)
            sums = [np.bincount(at, value * s[row, j], len(held)) for j in range(width)]
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), *map(pa.array, sums)], names=["i", *names])

    parts = vectors.mapInArrow(run, "i long, " + ", ".join(f"{x} double" for x in names))
    whole = parts.groupBy("i").agg(*[F.sum(x).alias(x) for x in names]).toArrow()
    out = np.zeros((size, width))
    out[whole.column("i").to_numpy()] = np.stack([whole.column(x).to_numpy() for x in names], axis=1)
    return out


def sparse_components(vectors: DataFrame, k: int, *, tol: float = 1e-7, seed: int = 42) -> np.ndarray:
    """M2 for wide sparse vectors (the only column of ``vectors``, to be scanned many times): the first ``k`` principal
    components, one per column.

    MLlib's PCA holds the covariance of all pairs of features on the driver.  Here the covariance is only ever applied
    to a few vectors at once, (X' (X v) - n mean (mean . v)) / (n - 1), by one Spark job over the stored entries; the
    driver keeps ``BLOCK * (KRYLOV_STEPS + 1)`` vectors of the vocabulary's length.  Block Krylov steps with restarts go on
    until each component's residual is at most ``tol`` times the largest variance, so a variance that several
    directions share is found, too (any of its directions is a component then)."""
    n, first = vectors.count(), vectors.first()
    size = first[0].size if first else 0
    if n < 2 or size < k:
        raise ValueError(f"{k} components need at least two rows and {k} features: {n} rows, {size} features")
    sc = vectors.sparkSession.sparkContext
    mean = _scatter(vectors, size, 1, lambda row, index, value, rows: np.ones((rows, 1)))[:, 0] / n

    def covariance(v: np.ndarray) -> np.ndarray:
        shared = sc.broadcast(v)
        try:
            out = _scatter(vectors, size, v.shape[1], lambda row, index, value, rows: _products(row, index, value, rows, shared.value))
        finally:
            shared.unpersist()
        return (out - n * np.outer(mean, mean @ v)) / (n - 1)

    block = min(BLOCK + k, size)
    basis = np.linalg.qr(np.random.default_rng(seed).normal(size=(size, block)))[0]
    image, newest = covariance(basis), block
    for step in range(1, MOST_STEPS + 1):
        small = basis.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        turn = turn[:, ::-1]
        top = basis @ turn[:, :k]
        left = np.linalg.norm(image @ turn[:, :k] - top * values[::-1][:k], axis=0)
        if left.max() <= tol * max(abs(values[-1]), 1e-300):
            return top
        if step % KRYLOV_STEPS == 0:
            basis, image, newest = basis @ turn[:, :block], image @ turn[:, :block], block
        fresh = image[:, -newest:]
        scale = np.linalg.norm(fresh, axis=0).max()
        for _ in range(2):
            fresh = fresh - basis @ (basis.T @ fresh)
        fresh, r = np.linalg.qr(fresh)
        fresh = fresh[:, np.abs(np.diag(r)) > 1e-12 * scale]
        fresh = fresh - basis @ (basis.T @ fresh)
        fresh = np.linalg.qr(fresh)[0] if fresh.shape[1] else fresh
        if not fresh.shape[1]:
            return top  # the basis spans all that the covariance makes of it
        basis, image, newest = np.hstack([basis, fresh]), np.hstack([image, covariance(fresh)]), fresh.shape[1]
    raise RuntimeError(f"no convergence after {MOST_STEPS} steps")


def project_sparse(points: DataFrame, features: str, components: np.ndarray, out: str = "projection") -> DataFrame:
    """``points`` with ``out`` (array<double>, the products with the components) in place of its vector column."""
    shared = points.sparkSession.sparkContext.broadcast(components)
    kept = [c for c in points.columns if c != features]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _products(*_entries(batch.column(len(kept))), batch.num_rows, shared.value)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(kept)], lists], names=[*kept, out])

    staged = points.select(*kept, features)
    return staged.mapInArrow(run, StructType([*staged.schema.fields[:-1], StructField(out, ArrayType(DoubleType()))]))


def cluster_titles(titles: DataFrame, *, text_col: str = "title", id_col: str = "id",
                   stop_words=None, min_df: float = 0.01, max_df: float = 0.5,
                   k: int = L.KMEANS_K, seed: int = L.KMEANS_SEED) -> DataFrame:
    """The title clustering flow: TF-IDF (uni+bigrams, stop words, df limits)
    -> 2-D PCA (M2, :func:`sparse_components`) -> k-means (M1).  Output ``id, title, projection, cluster``."""
    from creatorlens.operators.vectorize import tfidf_vectorizer
    vec = materialize(tfidf_vectorizer(text_col, ngram_range=(1, 2), stop_words=stop_words, min_df=min_df, max_df=max_df)
                      .fit(titles).transform(titles).select(id_col, text_col, "features"))
    proj = materialize(project_sparse(vec, "features", sparse_components(vec.select("features"), 2)))
    staged = proj.withColumn("_pca", array_to_vector("projection"))
    km = KMeans(k=k, seed=seed, featuresCol="_pca", predictionCol="cluster").fit(staged).transform(staged)
    return km.select(id_col, text_col, "projection", "cluster")
