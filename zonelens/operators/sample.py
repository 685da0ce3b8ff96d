"""Layout-independent sampling: Bernoulli by key hash, and a limit ordered by key hash."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from zonelens.functions.hashing import hash_keep, key_hash


def hash_sample(df: DataFrame, keys: Sequence[str], fraction: float) -> DataFrame:
    """Keep a deterministic ``fraction`` of rows, chosen by md5 of the key.

    A narrow filter (no shuffle); the same rows are chosen whatever the partitioning."""
    return df.filter(hash_keep(keys, fraction))


def hash_limit(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """``n`` rows chosen by the smallest key hashes.

    Plans as ``TakeOrderedAndProject``: each task keeps its own ``n`` best rows and only
    those reach the final merge, so memory is bounded by ``n`` per task."""
    return df.orderBy(key_hash(keys), *keys).limit(n)
