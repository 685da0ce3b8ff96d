"""Registry of the checked queries: one Spark plan per key and, where the result can be
written in SQL, an independent oracle SQL text over the same tables.

Every query reads whole driver tables (or data Spark derives from them).  Floating
columns are rounded to 6 decimals at the very end, on both sides, so the comparison
does not depend on summation order."""
from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from zonelens.session import table_path

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def round_half_up(c, digits: int = 6):
    """Round through decimal(38, 12): half-up on the decimal value, identical in Spark and
    in the SQL oracle (a plain double round differs between engines at exact ties such
    as 2.0534375).  Non-finite values pass through."""
    x = c.cast("double")
    dec = F.round(x.try_cast("decimal(38,12)"), digits).cast("double")
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), x).otherwise(F.coalesce(dec, F.round(x, digits)))


def finish(df: DataFrame, digits: int = 6) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append(round_half_up(F.col(f.name), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return finish(fn(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def load_all() -> None:
    """Import the query modules (each registers its keys)."""
    for mod in ("q_readings", "q_series", "q_stats", "q_text", "q_neighbours", "q_models", "q_io", "q_chains"):
        importlib.import_module(f"zonelens.plans.{mod}")
