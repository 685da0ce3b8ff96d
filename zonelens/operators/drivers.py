"""Principal components of a few standardised columns (the "drivers" analysis).

The only data-sized work is one aggregate producing the d x d covariance matrix
(all pairs in one job, partial per task); the eigen-decomposition of that small matrix
runs on the driver, whose cost depends on d, not on the row count.  So no sampling or
row limit is needed to keep memory bounded: all rows are used.  Standardising with the
sample standard deviation makes the covariance of the scaled columns the correlation
matrix (a constant column scales to 0 and carries no variance)."""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonelens.operators.stats import covariance_matrix


@dataclass
class PcaResult:
    variance: DataFrame   # component, explained_variance, cumulative_variance
    loadings: DataFrame   # component, feature, loading
    eigenvalues: np.ndarray
    components: np.ndarray  # d x d, column j = component j + 1


def _matrix(long_df: DataFrame, columns: Sequence[str], value: str) -> np.ndarray:
    idx = {c: i for i, c in enumerate(columns)}
    m = np.zeros((len(columns), len(columns)))
    for r in long_df.collect():  # d * d entries: bounded by the column count
        v = r[value]
        m[idx[r["p1"]], idx[r["p2"]]] = np.nan if v is None else v
    return m


def pca(df: DataFrame, columns: Sequence[str], *, k: int | None = None, standardize: bool = True) -> PcaResult:
    """Fit PCA with up to ``k`` components (default: all); each smaller k is a prefix.

    Signs are fixed so that the largest absolute loading of each component is positive."""
    spark = df.sparkSession
    cov = _matrix(covariance_matrix(df, columns), columns, "cov")
    cov = np.nan_to_num(cov)
    if standardize:
        sd = np.sqrt(np.clip(np.diag(cov), 0, None))
        inv = np.where(sd > 0, 1.0 / np.where(sd > 0, sd, 1.0), 0.0)
        cov = cov * np.outer(inv, inv)
    vals, vecs = np.linalg.eigh(cov)
    order = np.argsort(vals)[::-1]
    vals, vecs = np.clip(vals[order], 0, None), vecs[:, order]
    for j in range(vecs.shape[1]):
        if vecs[np.argmax(np.abs(vecs[:, j])), j] < 0:
            vecs[:, j] = -vecs[:, j]
    k = k or len(columns)
    total = vals.sum()
    ratio = vals / total if total > 0 else np.zeros_like(vals)
    var_rows = [(j + 1, float(ratio[j]), float(ratio[: j + 1].sum())) for j in range(k)]
    load_rows = [(j + 1, c, float(vecs[i, j])) for j in range(k) for i, c in enumerate(columns)]
    variance = spark.createDataFrame(var_rows, "component int, explained_variance double, cumulative_variance double")
    loadings = spark.createDataFrame(load_rows, "component int, feature string, loading double")
    return PcaResult(variance, loadings, vals[:k], vecs[:, :k])


def top_loadings(loadings: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` features with the largest absolute loading per component."""
    w = Window.partitionBy("component").orderBy(F.abs("loading").desc(), "feature")
    return (loadings.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n))
