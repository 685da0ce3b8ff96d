"""Logistic regression on hashed sparse features: fitted by Spark ML on a bounded table, applied
from one weight vector whose size is a parameter."""
from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship


def bucket(feature: str, size: int) -> int:
    return zlib.crc32(feature.encode("utf-8", "surrogatepass")) % size


@dataclass
class Linear:
    weights: np.ndarray
    bias: float

    def score(self, places, values) -> float:
        z = self.bias + float(np.dot(self.weights[places], values)) if len(places) else self.bias
        return 1.0 / (1.0 + np.exp(-min(max(z, -40.0), 40.0)))


def fit(rows: DataFrame, size: int, *, reg: float, iterations: int = 60) -> Linear | None:
    """Fit on (places array<int>, values array<double>, p double, weight double) rows: p is the
    probability of class 1, so each row counts p for it and 1 - p against it.  None where the rows
    speak for one class only (or there are none)."""
    vector = F.udf(lambda i, v: Vectors.sparse(size, i, v), VectorUDT())
    both = F.explode(F.array(F.struct(F.lit(1.0).alias("label"), F.col("p").alias("w")), F.struct(F.lit(0.0).alias("label"), (1 - F.col("p")).alias("w"))))
    train = rows.select(vector("places", "values").alias("features"), "weight", both.alias("y"))
    train = train.select("features", F.col("y.label").alias("label"), (F.col("weight") * F.col("y.w")).alias("weight")).filter("weight > 1e-6")
    # the table is bounded, so a few partitions hold it, and a round's gradients need no shuffle
    train = train.coalesce(4).cache()
    try:
        if train.select("label").distinct().count() < 2:
            return None
        model = LogisticRegression(weightCol="weight", regParam=reg, maxIter=iterations, standardization=False, tol=1e-7).fit(train)
        return Linear(model.coefficients.toArray(), float(model.intercept))
    finally:
        train.unpersist()


ship(__name__)
