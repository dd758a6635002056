"""Random Fourier features: the RBF-kernel half of the classifier grid (M5).

An RBF-kernel SVM has no exact distributed counterpart; following Rahimi &
Recht (2007), ``z(x) = sqrt(2 / D) * cos(W x + b)`` with ``W ~ N(0, 2 gamma I)``
and ``b ~ U(0, 2 pi)`` makes ``z(x) . z(y)`` approximate
``exp(-gamma ||x - y||^2)``, so a linear SVM on ``z`` approximates the kernel
SVM.  ``gamma="scale"`` is ``1 / (n_features * var(X))`` over the training
rows (one aggregate).  The projection runs per Arrow batch with numpy; Spark
partitions the rows.  ``kernel="linear"`` passes the features through, so one
estimator covers both kernels of a parameter grid.
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import IDF, ElementwiseProduct
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.linalg import Vectors
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, HasSeed
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf


@functools.lru_cache(maxsize=32)
def projection(d: int, width: int, gamma: float, seed: int) -> tuple[np.ndarray, np.ndarray, float]:
    """``W``, ``b`` and the factor of ``z(x)`` for vectors of ``d`` values: the same wherever they are drawn."""
    rng = np.random.default_rng(seed)
    w = rng.normal(0.0, np.sqrt(2.0 * gamma), size=(d, width))
    return w, rng.uniform(0.0, 2.0 * np.pi, size=width), float(np.sqrt(2.0 / width))


class _RFFParams(HasInputCol, HasOutputCol, HasSeed):
    kernel = Param(Params._dummy(), "kernel", "linear or rbf", typeConverter=TypeConverters.toString)
    numFeatures = Param(Params._dummy(), "numFeatures", "random features D", typeConverter=TypeConverters.toInt)
    gamma = Param(Params._dummy(), "gamma", "'scale' or a positive number", typeConverter=TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(kernel="rbf", numFeatures=256, gamma="scale", seed=42)


class RandomFourierFeatures(Estimator, _RFFParams):
    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, kernel="rbf", numFeatures=256, gamma="scale", seed=42):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "RandomFourierFeaturesModel":
        col = self.getInputCol()
        arr = vector_to_array(F.col(col))
        stats = df.select(F.size(arr).alias("d"), F.aggregate(arr, F.lit(0.0), lambda a, x: a + x).alias("s"),
                          F.aggregate(arr, F.lit(0.0), lambda a, x: a + x * x).alias("q")) \
            .agg(F.max("d").alias("d"), F.sum("s").alias("s"), F.sum("q").alias("q"), F.count(F.lit(1)).alias("n")) \
            .first()
        d = int(stats["d"] or 0)
        g = self.getOrDefault(self.gamma)
        if g == "scale":
            cells = max(d * int(stats["n"]), 1)
            var = stats["q"] / cells - (stats["s"] / cells) ** 2
            gamma = 1.0 / (d * var) if var > 0 and d > 0 else 1.0
        else:
            gamma = float(g)
        model = RandomFourierFeaturesModel(dim=d, gammaValue=gamma)
        model._set(inputCol=col, outputCol=self.getOutputCol(), kernel=self.getOrDefault(self.kernel),
                   numFeatures=self.getOrDefault(self.numFeatures), seed=self.getOrDefault(self.seed))
        return model


class RandomFourierFeaturesModel(Model, _RFFParams):
    def __init__(self, dim: int = 0, gammaValue: float = 1.0):
        super().__init__()
        self.dim, self.gammaValue = dim, gammaValue

    def kernel_map(self) -> "Kernel":
        """What :mod:`joint_svm` needs to make these features from the input column itself."""
        from creatorlens.operators.joint_svm import Kernel
        name, d = self.getOrDefault(self.kernel), self.dim
        return Kernel(name, d, d if name == "linear" else self.getOrDefault(self.numFeatures), self.gammaValue, self.getOrDefault(self.seed))

    def _transform(self, df: DataFrame) -> DataFrame:
        if self.getOrDefault(self.kernel) == "linear":
            return df.withColumn(self.getOutputCol(), F.col(self.getInputCol()))
        W, b, scale = projection(self.dim, self.getOrDefault(self.numFeatures), self.gammaValue, self.getOrDefault(self.seed))

        @pandas_udf("array<double>")
        def project(x: pd.Series) -> pd.Series:
            if len(x) == 0:
                return pd.Series([], dtype=object)
            X = np.stack([np.asarray(v, dtype=float) for v in x])
            Z = scale * np.cos(X @ W + b)
            return pd.Series(list(Z))

        return df.withColumn(self.getOutputCol(), array_to_vector(project(vector_to_array(F.col(self.getInputCol())))))

    def copy(self, extra=None):
        that = super().copy(extra)
        that.dim, that.gammaValue = self.dim, self.gammaValue
        return that


class SmoothIDF(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """IDF weights ``ln((n + 1) / (df + 1)) + 1``: MLlib's IDF plus one, so a term of
    every document keeps its count.  Fits MLlib's IDF, returns a JVM scaling."""

    @keyword_only
    def __init__(self, *, inputCol: str | None = None, outputCol: str | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset):
        idf = IDF(inputCol=self.getInputCol(), outputCol=self.getOutputCol()).fit(dataset).idf.toArray()
        return ElementwiseProduct(scalingVec=Vectors.dense(idf + 1.0), inputCol=self.getInputCol(), outputCol=self.getOutputCol())
