"""Helpers shared by the operators: table paths, reliable checkpoints, words, row keys."""
from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonelens.session import shared_dir, staging_path

# The ASCII white space that separates words, as a regular expression class
SPACES = r"[\x20\x09-\x0D]+"
NON_SPACES = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A table of at most so many rows (counted, never guessed) may be broadcast.
BROADCAST_ROWS = 100_000


def ship(module_name: str) -> None:
    """Send a module's Python functions to the workers by value, so that workers need not
    have this package on their path."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """Written to the shared checkpoint folder and read back: lineage ends here."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written as a (compressed) table below the shared folder and read back: for tables of a row
    a sentence or a word, which a checkpoint would hold uncompressed.  The table stays there
    until the folder is cleared, as results may be computed from it again."""
    path = staging_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lower_ascii(c: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(c, UPPER, LOWER)


def words(c: Column) -> Column:
    """The words of a text (null: none) as an array."""
    return F.array_remove(F.split(F.coalesce(c, F.lit("")), SPACES), "")


def packed(df: DataFrame, but: tuple = ()) -> Column:
    """The columns of ``df`` (without those in ``but``, whatever their letter case) in one struct: an operator's own columns
    stand beside it and can't clash with them."""
    return F.struct(*own(df, but))


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores behind it as keep it apart from the columns of ``df`` (in any letter case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def own(df: DataFrame, but: tuple = ()) -> list[Column]:
    """The columns of ``df`` without those in ``but``, whatever their letter case."""
    less = {c.lower() for c in but}
    return [F.col(f"`{c}`") for c in df.columns if c.lower() not in less]


def row_key(id_col: str, text_col: str) -> Column:
    """64-bit key of a row: equal for rows of equal id and equal text only (up to hash
    collisions), defined for nulls."""
    return F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("\0")), F.lit("|"),
                      F.coalesce(F.col(text_col), F.lit("\0")))


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``limit`` rows, else unchanged (the join
    then shuffles).  Pass checkpointed tables: the count runs a job."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df
