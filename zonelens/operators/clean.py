"""Cleaning of readings and raw station tables (filters, unit correction, casts).

All predicates are plain column expressions so Catalyst pushes them into the Parquet
scan (``PushedFilters: In(parameter, ..), GreaterThan(value, 0.0), LessThan(..)``).
"""
from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def valid_reading(measure_col: str, value_col: str, measures: Sequence[str],
                  low: float = 0.0, high: float = 1000.0) -> Column:
    """Membership in ``measures`` and the open interval ``low < value < high``."""
    return (F.col(measure_col).isin(list(measures))
            & (F.col(value_col) > F.lit(low)) & (F.col(value_col) < F.lit(high)))


def clean_readings(df: DataFrame, measures: Sequence[str], *, measure_col: str = "parameter",
                   value_col: str = "value", low: float = 0.0, high: float = 1000.0) -> DataFrame:
    """Keep readings of the listed measures whose value lies strictly inside (low, high).

    The bound is tested on the raw value, before any unit correction (as the original
    analysis does: a raw CO reading of 1000 is dropped although it is 1 after scaling).
    """
    return df.filter(valid_reading(measure_col, value_col, measures, low, high))


def scale_expr(measure_col: str, value_col: str, scale: Mapping[str, float]) -> Column:
    expr: Column | None = None
    for measure, factor in scale.items():
        cond = F.col(measure_col) == F.lit(measure)
        term = F.col(value_col) * F.lit(float(factor))
        expr = F.when(cond, term) if expr is None else expr.when(cond, term)
    return F.col(value_col) if expr is None else expr.otherwise(F.col(value_col))


def unit_correct(df: DataFrame, scale: Mapping[str, float], *, measure_col: str = "parameter",
                 value_col: str = "value") -> DataFrame:
    """Multiply the value of the listed measures by their factor (e.g. co: 1/1000)."""
    return df.withColumn(value_col, scale_expr(measure_col, value_col, scale))


def cast_measures(df: DataFrame, keys: Iterable[str], *, to: str = "double") -> DataFrame:
    """Cast every column but the keys to ``to`` in one projection.

    ``try_cast`` turns malformed numbers into null (the behaviour of a plain cast before
    ANSI mode) instead of failing the job."""
    keys = set(keys)
    return df.select(*[F.col(c) if c in keys else F.col(c).try_cast(to).alias(c) for c in df.columns])


def parse_time(df: DataFrame, col: str, fmt: str | None = None) -> DataFrame:
    """Parse a timestamp text column in place; malformed text becomes null."""
    parsed = F.try_to_timestamp(F.col(col), F.lit(fmt)) if fmt else F.try_to_timestamp(F.col(col))
    return df.withColumn(col, parsed)


def since(df: DataFrame, time_col: str, year: int) -> DataFrame:
    """Rows at or after 1 January of ``year``, written as a range predicate on the raw
    column so it can prune Parquet row groups (``year(ts) >= y`` cannot)."""
    dtype = df.schema[time_col].dataType.simpleString()
    bound = F.lit(f"{year:04d}-01-01 00:00:00").cast(dtype)
    return df.filter(F.col(time_col) >= bound)
