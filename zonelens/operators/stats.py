"""Column statistics applied back to rows: percentiles, capping, z-scores, scaling,
correlation and covariance matrices.

Global statistics reach the rows as *scalar subqueries* (``DataFrame.scalar()``): Spark
computes the one-row aggregate once, as its own small job with a partial phase per
task, and substitutes it as a constant.  No driver round trip in user code, no cross
join, and several statistics share one aggregate (one scan, one job).
"""
from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACCURACY = 10000  # percentile_approx default accuracy


def percentiles(df: DataFrame, columns: Sequence[str], q: float = 0.95, *,
                accuracy: int = ACCURACY, prefix: str = "p95_") -> DataFrame:
    """One row: the approximate ``q`` percentile of every column, in one aggregate.

    ``percentile_approx`` is a mergeable sketch: memory per task is bounded by the
    accuracy, not by the row count.  On inputs smaller than the accuracy it is exact
    and discrete (the smallest value with at least ``q`` of the rows at or below it)."""
    return df.agg(*[F.percentile_approx(c, q, accuracy).alias(f"{prefix}{c}") for c in columns])


def _stat_struct(df: DataFrame, aggs: Sequence[Column]) -> Column:
    return df.agg(F.struct(*aggs).alias("s")).scalar()


def winsorize(df: DataFrame, columns: Sequence[str], q: float = 0.95, *,
              drop_null: str | None = None, accuracy: int = ACCURACY) -> DataFrame:
    """Cap every column at its ``q`` percentile (a value strictly above is replaced).

    The percentiles are taken over all rows, including a null-key row; ``drop_null``
    names a key column whose null rows are removed after capping (original order)."""
    stats = _stat_struct(df, [F.percentile_approx(c, q, accuracy).alias(c) for c in columns])
    capped = [F.when(F.col(c) > stats.getField(c), stats.getField(c)).otherwise(F.col(c)).alias(c)
              for c in columns]
    out = df.select(*[c for c in df.columns if c not in columns], *capped).select(*df.columns)
    if drop_null is not None:
        out = out.filter(F.col(drop_null).isNotNull())
    return out


def global_stats(df: DataFrame, col: str) -> DataFrame:
    """Mean and sample standard deviation of one column (one row)."""
    return df.agg(F.avg(col).alias("mean"), F.stddev_samp(col).alias("std"))


def zscore(col: str, mean: Column, std: Column) -> Column:
    """(x - mean) / std; null when std is 0 or null instead of a division error."""
    return F.try_divide(F.col(col) - mean, std)


def zscore_filter(df: DataFrame, col: str, *, limit: float = 4.0, stats_from: DataFrame | None = None,
                  keep_score: bool = False) -> DataFrame:
    """Keep rows whose z-score of ``col`` lies in [-limit, limit] (inclusive).

    The mean and standard deviation come from ``stats_from`` (default: ``df`` itself,
    i.e. all rows, as in the original forecast; pass the training rows for a
    leak-free filter)."""
    src = stats_from if stats_from is not None else df
    s = _stat_struct(src, [F.avg(col).alias("m"), F.stddev_samp(col).alias("s")])
    z = zscore(col, s.getField("m"), s.getField("s"))
    out = df.withColumn("zscore", z).filter(F.col("zscore").between(-limit, limit))
    return out if keep_score else out.drop("zscore")


def standardize(df: DataFrame, columns: Sequence[str], *, keys: Sequence[str] = (),
                suffix: str = "") -> DataFrame:
    """(x - mean) / sample stddev per column; a constant column becomes 0 (the
    convention of Spark ML's ``StandardScaler(withMean=True, withStd=True)``)."""
    aggs = []
    for c in columns:
        aggs += [F.avg(c).alias(f"m_{c}"), F.stddev_samp(c).alias(f"s_{c}")]
    s = _stat_struct(df, aggs)
    out = []
    for c in columns:
        sd = s.getField(f"s_{c}")
        centred = F.col(c) - s.getField(f"m_{c}")
        out.append(F.when(sd > 0, centred / sd).otherwise(F.lit(0.0)).alias(f"{c}{suffix}"))
    return df.select(*keys, *out)


def _pair_matrix(df: DataFrame, columns: Sequence[str], fn, name: str) -> DataFrame:
    """All pairs (i <= j) of one aggregate function in one job, mirrored to a long
    (p1, p2, value) table of len(columns)^2 rows."""
    pairs = list(itertools.combinations_with_replacement(range(len(columns)), 2))
    row = df.agg(*[fn(columns[i], columns[j]).alias(f"v{i}_{j}") for i, j in pairs])
    entries = []
    for i, j in pairs:
        entries.append(F.struct(F.lit(columns[i]).alias("p1"), F.lit(columns[j]).alias("p2"),
                                F.col(f"v{i}_{j}").alias(name)))
        if i != j:
            entries.append(F.struct(F.lit(columns[j]).alias("p1"), F.lit(columns[i]).alias("p2"),
                                    F.col(f"v{i}_{j}").alias(name)))
    return row.select(F.inline(F.array(*entries)))


def correlation_matrix(df: DataFrame, columns: Sequence[str], *, dropna: bool = True) -> DataFrame:
    """Pearson correlation of every pair of columns, long form (p1, p2, r).

    Rows with a null in any of the columns are dropped first (complete cases), which
    is what a matrix over assembled vectors sees.  A constant column gives NaN/null."""
    src = df.dropna(how="any", subset=list(columns)) if dropna else df

    def corr(a, b):
        if a == b:
            return F.lit(1.0)
        # covariance over the product of deviations; a constant column has no
        # correlation (NaN, as in Spark ML) instead of failing on a zero division
        r = F.try_divide(F.covar_samp(a, b), F.stddev_samp(a) * F.stddev_samp(b))
        return F.when(F.count(F.lit(1)) > 1, F.coalesce(r, F.lit(float("nan"))))

    # the diagonal is 1 by definition (as in Spark ML's Correlation), even for a
    # constant column whose off-diagonal entries are undefined
    return _pair_matrix(src, columns, corr, "r")


def covariance_matrix(df: DataFrame, columns: Sequence[str], *, dropna: bool = True) -> DataFrame:
    """Sample covariance of every pair of columns, long form (p1, p2, cov)."""
    src = df.dropna(how="any", subset=list(columns)) if dropna else df
    return _pair_matrix(src, columns, F.covar_samp, "cov")


def top_pairs(matrix: DataFrame, value_col: str, columns: Sequence[str], n: int = 5) -> DataFrame:
    """The ``n`` upper-triangle pairs with the largest absolute value (ties by the
    column order), from a long matrix."""
    pos = F.create_map(*itertools.chain.from_iterable((F.lit(c), F.lit(i)) for i, c in enumerate(columns)))
    return (matrix.withColumn("i1", pos[F.col("p1")]).withColumn("i2", pos[F.col("p2")])
            .filter(F.col("i1") < F.col("i2"))
            .orderBy(F.abs(F.col(value_col)).desc_nulls_last(), "i1", "i2")
            .limit(n)
            .drop("i1", "i2"))
