"""Random Fourier features: an RBF kernel machine as a linear one (L-1, L-4).

For w ~ N(0, 2 gamma I) and b uniform in [0, 2 pi), the expectation of 2 cos(w'x + b) cos(w'y + b)
is exp(-gamma |x - y|^2). D such features make a linear classifier an approximate RBF one, at a
cost per row of D x width, whatever the number of rows.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, HasSeed
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPONENTS = 256

# tasks get the functions themselves, not an import of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def directions(width: int, n: int, gamma: float, seed: int):
    """(n x width frequencies, n phases), the same wherever they are drawn."""
    rng = np.random.default_rng(seed)
    return rng.normal(0.0, np.sqrt(2.0 * gamma), (n, width)), rng.uniform(0.0, 2 * np.pi, n)


def fourier(x: pa.Array, w: np.ndarray, b: np.ndarray) -> pa.Array:
    """The features of a column of vectors: one array of numbers, changed in place, and no object
    per row."""
    z = x.flatten().to_numpy(zero_copy_only=False).reshape(-1, w.shape[1]) @ w.T
    z += b
    np.cos(z, out=z)
    z *= np.sqrt(2.0 / len(b))
    ends = np.arange(0, z.size + 1, len(b), dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(z.ravel()))


class _FourierParams(HasInputCol, HasOutputCol, HasSeed):
    components = Param(Params._dummy(), "components", "number of random features", typeConverter=TypeConverters.toInt)
    gamma = Param(Params._dummy(), "gamma", "kernel width: a number, 'scale' (1 / (width x variance)) or 'auto' (1 / width)")

    def __init__(self, *args):
        super().__init__(*args)
        self._setDefault(components=COMPONENTS, gamma="scale", seed=42)


class FourierFeatures(Estimator, _FourierParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fits the kernel width to a vector column; the model maps it to random features."""

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, components=COMPONENTS, gamma="scale", seed=42):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "FourierModel":
        col, gamma = self.getInputCol(), self.getOrDefault(self.gamma)
        r = dataset.select(Summarizer.metrics("mean", "variance", "count").summary(F.col(col)).alias("s")).select("s.*").first()
        mean, var, n = r["mean"].toArray(), r["variance"].toArray(), max(r["count"], 1)
        width = len(mean)
        if gamma == "scale":                            # variance of all cells together
            total = float((var * (n - 1) / n + mean ** 2).mean() - mean.mean() ** 2)
            gamma = 1.0 / (width * total) if total > 0 else 1.0
        elif gamma == "auto":
            gamma = 1.0 / width
        model = FourierModel()
        model._resetUid(self.uid)
        return model._set(inputCol=col, outputCol=self.getOutputCol(), components=self.getOrDefault(self.components),
                          gamma=float(gamma), seed=self.getSeed(), width=width)


class FourierModel(Model, _FourierParams, DefaultParamsReadable, DefaultParamsWritable):
    width = Param(Params._dummy(), "width", "length of the input vectors", typeConverter=TypeConverters.toInt)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        args = (self.getOrDefault(self.width), self.getOrDefault(self.components), float(self.getOrDefault(self.gamma)), self.getSeed())

        @F.arrow_udf("array<double>")
        def features(x: pa.Array) -> pa.Array:
            return fourier(x, *directions(*args))

        return dataset.withColumn(self.getOutputCol(), array_to_vector(features(vector_to_array(F.col(self.getInputCol())))))
