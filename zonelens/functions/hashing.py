"""Deterministic hash predicates for sampling and ordered limits.

``df.sample`` and an unordered ``limit`` depend on partitioning, so the same data
gives other rows after a repartition.  Hashing the row key instead picks the same rows
on any layout, in Spark and in SQL engines alike (md5 of the key's text).
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_DIGITS = 8  # leading hex digits of md5 compared: 32 bits of resolution


def key_text(keys: Sequence[str]) -> Column:
    """The key columns as one text, joined with '|' (a single key: its plain text)."""
    if len(keys) == 1:
        return F.col(keys[0]).cast("string")
    return F.concat_ws("|", *[F.col(k).cast("string") for k in keys])


def key_hash(keys: Sequence[str]) -> Column:
    """Leading hex digits of md5(key text): a uniform, layout-independent sort key."""
    return F.substring(F.md5(key_text(keys)), 1, HASH_DIGITS)


def threshold_hex(fraction: float) -> str:
    """Hex threshold below which a fraction ``fraction`` of uniform hashes falls."""
    if fraction <= 0:
        return "0" * HASH_DIGITS
    n = min(int(round(fraction * 16 ** HASH_DIGITS)), 16 ** HASH_DIGITS)
    if n >= 16 ** HASH_DIGITS:
        return "g"  # sorts after every hex digit: keep all
    return format(n, f"0{HASH_DIGITS}x")


def hash_keep(keys: Sequence[str], fraction: float) -> Column:
    """True for a deterministic ``fraction`` of the keys (Bernoulli by hash)."""
    return key_hash(keys) < F.lit(threshold_hex(fraction))
