"""Builders for the oracle SQL texts (plain ANSI SQL as DuckDB runs it).

The oracle is an independent formulation of each query over the raw tables; these
helpers only spell out repetitive parts (one filtered aggregate per measure, one
union branch per matrix entry)."""
from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence

from zonelens.plans.config import EVENT_MEASURES, EVENT_SCALE, VALID_HIGH, VALID_LOW


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def in_list(values: Sequence[str]) -> str:
    return ", ".join(q(v) for v in values)


def r6(expr: str) -> str:
    """Half-up rounding through DECIMAL(38, 12), as the Spark side does."""
    x = f"CAST({expr} AS DOUBLE)"
    return (f"(CASE WHEN isnan({x}) OR isinf({x}) THEN {x} "
            f"ELSE coalesce(CAST(round(TRY_CAST({x} AS DECIMAL(38, 12)), 6) AS DOUBLE), round({x}, 6)) END)")


def valid_events(measures: Sequence[str] = EVENT_MEASURES) -> str:
    return f"event_type IN ({in_list(measures)}) AND value > {VALID_LOW} AND value < {VALID_HIGH}"


def scaled_value(scale: Mapping[str, float] = EVENT_SCALE) -> str:
    if not scale:
        return "value"
    whens = " ".join(f"WHEN event_type = {q(m)} THEN value * {f!r}" for m, f in scale.items())
    return f"CASE {whens} ELSE value END"


def profile_cte(measures: Sequence[str] = EVENT_MEASURES) -> str:
    cols = ",\n       ".join(
        f"coalesce(avg({scaled_value()}) FILTER (WHERE event_type = {q(m)}), 0) AS {m}_avg" for m in measures)
    return f"SELECT user_id AS district,\n       {cols}\nFROM events WHERE {valid_events(measures)}\nGROUP BY user_id"


def pair_union(columns: Sequence[str], agg: str, name: str, source: str, diag: str | None = None) -> str:
    parts = []
    for a, b in itertools.product(columns, columns):
        expr = diag if (diag is not None and a == b) else f"{agg}({a}, {b})"
        parts.append(f"SELECT {q(a)} AS p1, {q(b)} AS p2, {r6(expr)} AS {name} FROM {source}")
    return "\nUNION ALL\n".join(parts)
