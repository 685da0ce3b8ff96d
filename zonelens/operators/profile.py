"""Profiles: pivoted means, concurrent vectors, row-count profile, arg-max over columns.

A pivot with a fixed value list is written as one filtered aggregate per value
(``avg(value) FILTER (WHERE parameter = p)``): a single hash aggregate with a partial
(map-side) phase, one shuffle, instead of the two aggregation rounds of
``groupBy().pivot()``.  Partial aggregation also pre-combines a hot key before the
shuffle, so one district holding a third of the rows costs one partial row per task.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonelens.operators.clean import scale_expr, valid_reading


def pivot_mean(df: DataFrame, keys: Sequence[str], measures: Sequence[str], *,
               measure_col: str = "parameter", value_col: str = "value",
               suffix: str = "", fill: float | None = None) -> DataFrame:
    """One row per key, one ``<measure><suffix>`` column holding the mean value of that measure.

    ``fill`` replaces a missing measure (no reading for this key) by a constant; ``None``
    keeps it null."""
    aggs = []
    for m in measures:
        a = F.avg(F.when(F.col(measure_col) == F.lit(m), F.col(value_col)))
        if fill is not None:
            a = F.coalesce(a, F.lit(float(fill)))
        aggs.append(a.alias(f"{m}{suffix}"))
    return df.groupBy(*keys).agg(*aggs)


def district_profile(readings: DataFrame, measures: Sequence[str], *, key: str = "district",
                     scale: Mapping[str, float] | None = None, low: float = 0.0, high: float = 1000.0,
                     measure_col: str = "parameter", value_col: str = "value") -> DataFrame:
    """Mean of each measure per district after cleaning and unit correction; a measure
    never observed in a district is 0; columns are named ``<measure>_avg``.

    A null district forms its own group (it takes part in later percentiles and is
    removed afterwards by :func:`zonelens.operators.stats.winsorize`)."""
    value = scale_expr(measure_col, value_col, scale or {})
    cleaned = (readings.filter(valid_reading(measure_col, value_col, measures, low, high))
               .select(key, measure_col, value.alias(value_col)))
    return pivot_mean(cleaned, [key], measures, measure_col=measure_col, value_col=value_col,
                      suffix="_avg", fill=0.0)


def hourly_vectors(readings: DataFrame, measures: Sequence[str], *,
                   keys: Sequence[str] = ("district", "year", "hour"),
                   scale: Mapping[str, float] | None = None, low: float = 0.0, high: float = 1000.0,
                   measure_col: str = "parameter", value_col: str = "value") -> DataFrame:
    """Mean of each measure per (district, year, hour of day); missing measures are 0."""
    value = scale_expr(measure_col, value_col, scale or {})
    cleaned = (readings.filter(valid_reading(measure_col, value_col, measures, low, high))
               .select(*keys, measure_col, value.alias(value_col)))
    return pivot_mean(cleaned, list(keys), measures, measure_col=measure_col, value_col=value_col, fill=0.0)


def concurrent_vectors(readings: DataFrame, measures: Sequence[str], *,
                       keys: Sequence[str] = ("location", "datetime"), grain: str | None = None,
                       time_col: str = "datetime", required: Sequence[str] | None = None,
                       low: float = 0.0, high: float = 1000.0,
                       measure_col: str = "parameter", value_col: str = "value") -> DataFrame:
    """Readings taken together: one row per (location, time), one column per measure.

    The value of a measure in a cell is the one of its earliest reading (``min_by`` on
    time, then value): deterministic where the original ``first`` depends on partition
    order.  ``grain`` truncates the time key (``'hour'``, ``'day'``) so readings close in
    time count as concurrent.  Cells lacking any ``required`` measure (default: all) are
    dropped, so no zero-filled values enter a correlation.
    """
    cols = list(keys)
    df = (readings.filter(valid_reading(measure_col, value_col, measures, low, high))
          .withColumn("_t", F.col(time_col)))
    if grain is not None:
        dtype = readings.schema[time_col].dataType.simpleString()
        df = df.withColumn(time_col, F.date_trunc(grain, F.col(time_col)).cast(dtype))
    order = F.struct(F.col("_t"), F.col(value_col))
    aggs = [F.min_by(F.col(value_col), F.when(F.col(measure_col) == F.lit(m), order)).alias(m)
            for m in measures]
    out = df.groupBy(*cols).agg(*aggs)
    need = list(required) if required is not None else list(measures)
    return out.dropna(how="any", subset=need)


def measure_argmax(columns: Sequence[str], names: Sequence[str] | None = None) -> tuple[Column, Column]:
    """(name, value) of the largest of ``columns``; ties go to the first column listed;
    null columns are ignored."""
    names = list(names) if names is not None else list(columns)
    top = F.greatest(*[F.col(c) for c in columns])
    name: Column | None = None
    for c, n in zip(columns, names):
        cond = F.col(c) == top
        name = F.when(cond, F.lit(n)) if name is None else name.when(cond, F.lit(n))
    return name, top


def dominant_measure(df: DataFrame, columns: Sequence[str], *, keys: Sequence[str],
                     names: Sequence[str] | None = None) -> DataFrame:
    """Per row: the dominant measure (largest column) and its value."""
    name, top = measure_argmax(columns, names)
    return df.select(*keys, name.alias("dominant_measure"), top.alias("dominant_value"))


def row_counts(readings: DataFrame, measures: Sequence[str], *, scale: Mapping[str, float] | None = None,
               low: float = 0.0, high: float = 1000.0, measure_col: str = "parameter",
               value_col: str = "value", key: str = "district") -> DataFrame:
    """The data checks of the original scripts as one aggregate (one job, one scan)."""
    valid = valid_reading(measure_col, value_col, measures, low, high)
    scaled = F.col(measure_col).isin(list((scale or {}).keys())) if scale else F.lit(False)
    return readings.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(measure_col).isin(list(measures))).alias("n_measured"),
        F.count_if(valid).alias("n_valid"),
        F.count_if(valid & scaled).alias("n_scaled"),
        F.count_if(F.col(key).isNull()).alias("n_null_key"),
        F.count_if(F.col(value_col).isNull()).alias("n_null_value"),
    )
