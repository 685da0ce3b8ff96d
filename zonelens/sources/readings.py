"""Readings: the long (location, district, datetime, parameter, value) table and the
wide per-station table, plus adapters from the driver's ``events`` table.

The canonical long shape keeps one reading per row.  ``year`` and ``hour`` are derived
from ``datetime`` instead of being demanded from the file.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

READINGS_COLUMNS = ("location", "district", "datetime", "parameter", "value")


def scan_readings(spark: SparkSession, path: str, *, derive_calendar: bool = True) -> DataFrame:
    """Parquet scan of a long readings table; checks the canonical columns are present.

    No cache here: caching a raw scan blocks Parquet filter pushdown and column pruning
    for every later operator, so only cleaned projections are ever persisted.
    """
    df = spark.read.parquet(path)
    return conform_readings(df, derive_calendar=derive_calendar)


def conform_readings(df: DataFrame, *, derive_calendar: bool = True) -> DataFrame:
    missing = [c for c in READINGS_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"readings table lacks columns {missing}")
    cols: list[Column | str] = [F.col(c) for c in READINGS_COLUMNS]
    if derive_calendar:
        cols += [F.year("datetime").alias("year"), F.hour("datetime").alias("hour")]
    return df.select(*cols)


def readings_from_events(events: DataFrame, *, derive_calendar: bool = True) -> DataFrame:
    """The ``events`` table read as readings: one user is one location and one district,
    ``ts`` is the reading time, ``event_type`` the measured parameter."""
    df = events.select(
        F.col("user_id").alias("location"),
        F.col("user_id").alias("district"),
        F.col("ts").alias("datetime"),
        F.col("event_type").alias("parameter"),
        F.col("value"),
    )
    return conform_readings(df, derive_calendar=derive_calendar)


def station_table_from_events(events: DataFrame) -> DataFrame:
    """The ``events`` table read as a wide station table: ``user_id`` is the station,
    ``ts`` the reading time, ``value`` the target measure and the numeric ``k`` field of
    ``props`` a second measure (the role of PM10 next to PM2.5)."""
    return events.select(
        F.col("user_id").alias("station"),
        F.col("ts").alias("ReadTime"),
        F.col("value").alias("PM25"),
        F.get_json_object("props", "$.k").try_cast("double").alias("PM10"),
    )
