"""Registered chains over ``events``: components of the hourly vectors, correlation of the
concurrent vectors (the analyses of ``plans.analyses`` on the readings they are meant for)."""
from __future__ import annotations

from zonelens.operators import drivers as drv
from zonelens.operators import profile, stats
from zonelens.plans import analyses, q_readings
from zonelens.plans.config import EVENT_MEASURES as M
from zonelens.plans.config import EVENT_SCALE, VALID_HIGH, VALID_LOW
from zonelens.plans.registry import register
from zonelens.plans.sqltext import pair_union, q, scaled_value, valid_events

HOURLY = "(SELECT " + ", ".join(
    f"coalesce(avg({scaled_value()}) FILTER (WHERE event_type = {q(m)}), 0) AS {m}" for m in M) + (
    f" FROM events WHERE {valid_events()} GROUP BY user_id, year(ts), hour(ts)) t")
CONCURRENT = "(SELECT * FROM (SELECT " + ", ".join(f"arg_min(value, ts) FILTER (WHERE event_type = {q(m)}) AS {m}" for m in M) + (
    f" FROM events WHERE {valid_events()} GROUP BY user_id, date_trunc('day', ts)) c WHERE "
    + " AND ".join(f"{m} IS NOT NULL" for m in M) + ") t")


def hourly(spark, sf):
    return profile.hourly_vectors(q_readings.readings(spark, sf), M, scale=EVENT_SCALE, low=VALID_LOW, high=VALID_HIGH)


@register("hourly_covariance", pair_union(M, "covar_samp", "cov", HOURLY))
def hourly_covariance(spark, sf):
    """H14 (oracle part) over D2: sample covariance of the hourly vectors."""
    return stats.covariance_matrix(hourly(spark, sf), M)


@register("hourly_pca")
def hourly_pca(spark, sf):
    """D2 + H14: explained variance of the components of the hourly vectors."""
    return analyses.drivers(q_readings.readings(spark, sf), M, scale=EVENT_SCALE).variance


@register("hourly_pca_topk")
def hourly_pca_topk(spark, sf):
    """D2 + H14 + F3: top 3 measures by absolute loading per component."""
    return drv.top_loadings(analyses.drivers(q_readings.readings(spark, sf), M, scale=EVENT_SCALE).loadings, 3)


@register("concurrent_correlation", pair_union(M, "corr", "r", CONCURRENT, diag="1.0 + 0 * count(*)"))
def concurrent_correlation(spark, sf):
    """D3 + D10: Pearson matrix of the concurrent vectors, one a location and day."""
    return analyses.correlations(q_readings.readings(spark, sf), M, grain="day").matrix
