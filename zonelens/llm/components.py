"""Connected components by alternating large-star and small-star rounds, as DataFrame
joins and aggregates.  Every round is checkpointed; the driver sees two numbers a round.  The
smallest neighbours are checkpointed before they are joined back: two plain shuffles can be split
by adaptive skew handling where one node has a large share of all links, an aggregate can't."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(r)


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to its smallest neighbour (or itself)."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = checkpointed(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
    return both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = checkpointed(down.groupBy("a").agg(F.min("b").alias("m")))
    moved = down.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
    return moved.unionByName(low.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected links (a, b): root is the smallest node
    reachable.  Nodes without links are not listed.  Self links and repeats are ignored;
    no links give an empty table."""
    edges = checkpointed(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = _state(edges)
    while True:
        edges = checkpointed(_small_star(_large_star(edges)))
        before, state = state, _state(edges)
        if state == before:
            break
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
