"""Registered queries over ``lineitem`` as a wide numeric table: scaling, correlation,
covariance and principal components."""
from __future__ import annotations

from zonelens.operators import drivers, stats
from zonelens.plans.config import LINEITEM_MEASURES as LM
from zonelens.plans.registry import register, table
from zonelens.plans.sqltext import pair_union, q, r6

NOT_NULL = " AND ".join(f"{c} IS NOT NULL" for c in LM)
COMPLETE = f"(SELECT * FROM lineitem WHERE {NOT_NULL}) t"


def lineitem(spark, sf):
    return table(spark, sf, "lineitem")


@register("standardize", "WITH s AS (SELECT " + ", ".join(
    f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in LM) + " FROM lineitem)\nSELECT l_orderkey, l_linenumber, "
    + ", ".join(r6(f"CASE WHEN s_{c} > 0 THEN ({c} - m_{c}) / s_{c} ELSE 0 END") + f" AS {c}" for c in LM)
    + " FROM lineitem, s")
def standardize(spark, sf):
    """H2: mean 0, sample stddev 1 per column (a constant column becomes 0)."""
    return stats.standardize(lineitem(spark, sf), LM, keys=["l_orderkey", "l_linenumber"])


@register("correlation_matrix", pair_union(LM, "corr", "r", COMPLETE, diag="1.0 + 0 * count(*)"))
def correlation_matrix(spark, sf):
    """Pearson matrix of all pairs in one aggregate, long form (p1, p2, r)."""
    return stats.correlation_matrix(lineitem(spark, sf), LM)


_POS = "CASE " + " ".join(f"WHEN {{c}} = {q(c)} THEN {i}" for i, c in enumerate(LM)) + " END"


@register("correlation_top", "WITH m AS (" + pair_union(LM, "corr", "r", COMPLETE, diag="1.0 + 0 * count(*)") + ")\n"
          "SELECT p1, p2, r FROM m WHERE " + _POS.replace("{c}", "p1") + " < " + _POS.replace("{c}", "p2")
          + "\nORDER BY abs(r) DESC, " + _POS.replace("{c}", "p1") + ", " + _POS.replace("{c}", "p2") + " LIMIT 5")
def correlation_top(spark, sf):
    """the five upper-triangle pairs with the strongest correlation."""
    m = stats.correlation_matrix(lineitem(spark, sf), LM)
    return stats.top_pairs(m, "r", LM, 5)


@register("covariance_matrix", pair_union(LM, "covar_samp", "cov", COMPLETE))
def covariance_matrix(spark, sf):
    """H14 (oracle part): sample covariance matrix, long form (p1, p2, cov)."""
    return stats.covariance_matrix(lineitem(spark, sf), LM)


@register("pca_drivers")
def pca_drivers(spark, sf):
    """Principal components of the standardised columns: explained variance per
    component and cumulative, for k = 1..d (smaller k is a prefix of the largest fit)."""
    return drivers.pca(lineitem(spark, sf), LM).variance


@register("pca_loadings_topk")
def pca_loadings_topk(spark, sf):
    """top 3 columns by absolute loading per component."""
    return drivers.top_loadings(drivers.pca(lineitem(spark, sf), LM).loadings, 3)
