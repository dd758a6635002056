"""Title classification (M3-M6) with MLlib.

* M3: reproducible 80/20 split by hashing a stable key (independent of how the
  data happens to be partitioned, unlike ``randomSplit``).
* M4: TF-IDF features -> one-vs-rest linear SVM.  ``regParam = 1 / (C * n)``
  maps the soft-margin constant C onto MLlib's regularisation.
* M5: 5-fold cross-validated grid over kernel {linear, rbf} x C (accuracy),
  folds by the same hash; rbf = random Fourier features (approximate).  The
  sparse vectors of a fold are made once and kept while its classifiers, those of
  all kernels, C and classes, are fitted side by side (``operators.joint_svm``).
* M6: the fitted pipeline scores any table of titles in batch.

The vectoriser is fitted on the training rows only; its weights are
ln((n + 1) / (df + 1)) + 1, as in the long form (``operators.vectorize``).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LinearSVCModel, OneVsRest, OneVsRestModel
from pyspark.ml.feature import CountVectorizer, Normalizer, RegexTokenizer, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.wrapper import JavaParams
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from creatorlens.operators.joint_svm import Fitted, fit_together, shares
from creatorlens.session import materialize


def hash_split(df: DataFrame, key: str, *, test_percent: int = 20, seed: int = 42, col: str = "is_test") -> DataFrame:
    """M3: ``is_test`` for about ``test_percent`` % of rows, stable per key (an
    md5 of seed and key, so any engine can repeat the split)."""
    text = F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"))
    bucket = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % 100
    return df.withColumn(col, bucket < test_percent)


def fold_column(df: DataFrame, key: str, *, folds: int = 5, seed: int = 7, col: str = "fold") -> DataFrame:
    """Fold id in [0, folds) per key, for ``CrossValidator(foldCol=...)``."""
    return df.withColumn(col, F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(folds)).cast("int"))


def svm_estimator(title: str = "title", label: str = "category", *, vocab_size: int = 1000,
                  reg_param: float = 0.01, max_iter: int = 30, tol: float = 1e-4, parallelism: int = 4,
                  kernel: str = "linear") -> Pipeline:
    """M4: tokens -> counts (top ``vocab_size`` terms) -> IDF -> L2 -> kernel map
    (identity, or random Fourier features for ``rbf``) -> OvR(LinearSVC)."""
    from creatorlens.operators.kernels import RandomFourierFeatures, SmoothIDF
    return Pipeline(stages=[
        StringIndexer(inputCol=label, outputCol="_label", handleInvalid="keep"),
        RegexTokenizer(inputCol=title, outputCol="_tokens", pattern=r"[\p{L}\p{N}_]{2,}", gaps=False,
                       toLowercase=True),
        CountVectorizer(inputCol="_tokens", outputCol="_tf", vocabSize=vocab_size),
        SmoothIDF(inputCol="_tf", outputCol="_tfidf"),
        Normalizer(inputCol="_tfidf", outputCol="_unit", p=2.0),
        RandomFourierFeatures(inputCol="_unit", outputCol="_features", kernel=kernel),
        OneVsRest(classifier=LinearSVC(regParam=reg_param, maxIter=max_iter, tol=tol), featuresCol="_features",
                  labelCol="_label", predictionCol="_pred", parallelism=parallelism),
    ])


def linear_scores(ovr: OneVsRestModel, vectors: DataFrame, features: str = "_features", out: str = "_pred") -> DataFrame:
    """The class of the greatest ``w . x + b`` (the first of equal ones), from the fitted weights alone: one matrix
    product per Arrow batch.  The fitted model itself, which holds its session, stays on the driver."""
    weights = np.array([m.coefficients.toArray() for m in ovr.models])
    offsets = np.array([m.intercept for m in ovr.models])

    @pandas_udf("double")
    def best(x: pd.Series) -> pd.Series:
        if len(x) == 0:
            return pd.Series([], dtype=float)
        return pd.Series((np.stack([np.asarray(v, dtype=float) for v in x]) @ weights.T + offsets).argmax(1).astype(float))

    return vectors.withColumn(out, best(vector_to_array(F.col(features))))


def with_label_names(model: PipelineModel, scored: DataFrame, out: str = "prediction") -> DataFrame:
    """Map predicted indices back to category names."""
    names = F.array(*[F.lit(x) for x in model.stages[0].labels])
    return scored.withColumn(out, F.try_element_at(names, F.col("_pred").cast("int") + 1))


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` held by the executors for as long as it is used: MLlib's fits scan it many times, and the vectors of the rbf
    kernel are a hundred times larger than the titles they are made of, so they are not written."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist(blocking=True)


def fit_svm(train: DataFrame, title: str = "title", label: str = "category", *, c: float = 1.0,
            vocab_size: int = 1000, n_train: int | None = None, vectorise: DataFrame | None = None,
            kernel: str = "linear", solver: str = "mllib") -> PipelineModel:
    """M4: fit on training rows; C is mapped to ``regParam = 1 / (C * n_train)``.
    The training rows are written once: every pipeline stage scans them.  Their vectors are only kept while it lasts.

    ``solver="joint"``: the same problem, but the classifiers of all classes share each pass (``operators.joint_svm``),
    and of the rbf kernel's vectors none are stored.

    ``vectorise``: rows that labels, vocabulary and weights are learned from instead of the training rows (D15: all
    rows, as when the vectoriser is fitted before the split)."""
    train = materialize(train)
    n = n_train if n_train is not None else train.count()
    *features, ovr = svm_estimator(title, label, vocab_size=vocab_size, reg_param=1.0 / (c * max(n, 1)), kernel=kernel).getStages()
    vectors = Pipeline(stages=features).fit(train if vectorise is None else materialize(vectorise))
    if solver == "joint":
        svc, classes = ovr.getClassifier(), len(vectors.stages[0].labels) + 1
        with kept(PipelineModel(vectors.stages[:-1]).transform(train).select("_label", "_unit")) as rows:
            one, = fit_together(rows, [vectors.stages[-1].kernel_map()], classes, [svc.getRegParam()], max_iter=svc.getMaxIter(), tol=svc.getTol())
        return PipelineModel([*vectors.stages, one_vs_rest(ovr, one)])
    with kept(vectors.transform(train).select("_label", "_features")) as rows:
        model = ovr.fit(rows)
    return PipelineModel([*vectors.stages, model])


def one_vs_rest(ovr: OneVsRest, fitted: Fitted) -> OneVsRestModel:
    """The model that ``ovr`` makes of classifiers that were fitted together, one for each class."""
    svc = ovr.getClassifier()
    svc = svc.copy({svc.featuresCol: ovr.getFeaturesCol(), svc.predictionCol: ovr.getPredictionCol()})
    models = []
    for weights, offset in zip(fitted.weights.T, fitted.offsets, strict=True):
        made = JavaParams._new_java_obj("org.apache.spark.ml.classification.LinearSVCModel", svc.uid, Vectors.dense(weights), float(offset))
        models.append(svc._copyValues(LinearSVCModel(made)))
    return ovr._copyValues(OneVsRestModel(models=models))


def predict(model: PipelineModel, df: DataFrame, out: str = "prediction") -> DataFrame:
    """M6: batch scoring of new titles."""
    *features, ovr = model.stages
    vectors = PipelineModel(features).transform(df)
    made = [c for c in vectors.columns if c not in df.columns]
    return with_label_names(model, linear_scores(ovr, vectors), out).drop("_pred", *made)


def title_vectors(train: DataFrame, title: str = "title", *, vocab_size: int = 1000) -> PipelineModel:
    """The TF-IDF stages of M4 alone (unit vectors in ``_unit``), fitted on ``train``."""
    _, *stages = svm_estimator(title, vocab_size=vocab_size).getStages()[:-2]
    return Pipeline(stages=stages).fit(train)


def with_title_vectors(vectoriser: PipelineModel, df: DataFrame, out: str = "features") -> DataFrame:
    """``df`` with its unit TF-IDF vector as an array<double>."""
    made = vectoriser.transform(df)
    return made.select(*df.columns, vector_to_array("_unit").alias(out))


def grid_search(train: DataFrame, title: str = "title", label: str = "category", key: str = "id", *,
                cs: Sequence[float] = (0.1, 1.0, 10.0), kernels: Sequence[str] = ("linear", "rbf"),
                folds: int = 5, vocab_size: int = 1000, max_iter: int = 10, tol: float = 1e-2,
                parallelism: int = 6) -> tuple[PipelineModel, list[tuple[str, float, float]]]:
    """M5: k-fold grid over kernel x C scored by accuracy; returns the refitted
    best pipeline and ``[(kernel, C, mean accuracy)]``.  ``rbf`` is the random
    Fourier feature approximation (``operators.kernels``).  ``max_iter`` and ``tol``
    hold for the folds; the best setting is fitted as :func:`fit_svm` does."""
    spread = fold_column(train, key, folds=folds).repartition(train.sparkSession.sparkContext.defaultParallelism)  # titles are few bytes: a file of a million is one or two splits
    data = materialize(spread)
    n = data.count()
    regs = [folds / (c * max(n, 1) * max(folds - 1, 1)) for c in cs]

    def fold_scores(fold: int) -> list[list[float]]:
        rest, held = data.where(F.col("fold") != fold), data.where(F.col("fold") == fold)
        *stages, _, _ = svm_estimator(title, label, vocab_size=vocab_size).getStages()
        vectors = Pipeline(stages=stages).fit(rest)
        classes = len(vectors.stages[0].labels) + 1  # and that of labels which only other folds have
        fit, test = (vectors.transform(part).select("_label", "_unit") for part in (rest, held))
        with kept(fit):
            maps = [svm_estimator(kernel=kernel).getStages()[-2].fit(fit).kernel_map() for kernel in kernels]
            return shares(test, fit_together(fit, maps, classes, regs, max_iter=max_iter, tol=tol), classes)

    with ThreadPoolExecutor(max(1, min(parallelism, folds))) as pool:  # the driver only waits for Spark's jobs
        got = list(pool.map(fold_scores, range(folds)))
    scores = [(kernel, c, sum(fold[k][i] for fold in got) / folds) for k, kernel in enumerate(kernels) for i, c in enumerate(cs)]
    kernel, c, _ = max(scores, key=lambda s: s[2])
    return fit_svm(data, title, label, c=c, vocab_size=vocab_size, n_train=n, kernel=kernel, solver="joint"), scores
