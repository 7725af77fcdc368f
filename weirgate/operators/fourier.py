"""Random Fourier features: a vector map under which dot products are those of a Gaussian kernel."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql.functions import arrow_udf

# Directions a worker keeps; others are drawn again from their own seeds.
HELD = 1 << 15


class Directions:
    """The random direction of each input dimension, drawn from the seed and its number alone."""

    def __init__(self, features: int, gamma: float, seed: int) -> None:
        self.features, self.scale, self.seed = features, np.sqrt(2 * gamma), seed
        self.shift = np.random.Generator(np.random.Philox(key=[seed, 1 << 62])).uniform(0, 2 * np.pi, features)
        self.held: dict[int, np.ndarray] = {}

    def of(self, dimension: int) -> np.ndarray:
        found = self.held.get(dimension)
        if found is None:
            draw = np.random.Generator(np.random.Philox(key=[self.seed, dimension]))
            found = (draw.standard_normal(self.features) * self.scale).astype(np.float32)
            if len(self.held) >= HELD:
                self.held.clear()
            self.held[dimension] = found
        return found

    def map(self, indices: np.ndarray, values: np.ndarray) -> np.ndarray:
        angle = self.shift.copy()
        for i, x in zip(indices.tolist(), values.tolist()):
            angle += x * self.of(i)
        return np.sqrt(2.0 / self.features) * np.cos(angle)


def _mapped(features: int, gamma: float, seed: int) -> Callable[[pa.Array], pa.Array]:
    state: list[Directions] = []

    def mapped(vectors: pa.Array) -> pa.Array:
        if not state:
            state.append(Directions(features, gamma, seed))
        out = []
        for v in vectors:
            if not v.is_valid:
                out.append(None)
                continue
            values = v["values"].values.to_numpy(zero_copy_only=False)
            sparse = v["type"].as_py() == 0
            indices = v["indices"].values.to_numpy(zero_copy_only=False) if sparse else np.arange(len(values))
            out.append(state[0].map(indices, values))
        return pa.array(out, pa.list_(pa.float64()))

    return mapped


class FourierFeatures(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """``features`` cosines of random projections of a vector column.

    The dot product of two outputs comes near ``exp(-gamma |x - y|^2)``, the more so the more
    features, so a linear learner on them learns what one with that kernel would, and its work
    grows with the rows alone. Directions come from seeds by dimension: nothing is stored or
    broadcast, whatever the size of the input space. A null vector gives a null one.
    """

    features = Param(Params._dummy(), "features", "number of cosines", TypeConverters.toInt)
    gamma = Param(Params._dummy(), "gamma", "width of the kernel", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "seed of the directions", TypeConverters.toInt)

    @keyword_only
    def __init__(self, inputCol: str = "_x", outputCol: str = "features", features: int = 512, gamma: float = 0.1, seed: int = 7) -> None:
        super().__init__()
        self._setDefault(inputCol="_x", outputCol="features", features=512, gamma=0.1, seed=7)
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        get = lambda p: self.getOrDefault(p)
        udf = arrow_udf(_mapped(get("features"), get("gamma"), get("seed")), "array<double>")
        return dataset.withColumn(get("outputCol"), array_to_vector(udf(dataset[get("inputCol")])))
