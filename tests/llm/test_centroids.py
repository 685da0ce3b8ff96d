"""Centroid clustering against plain integer arithmetic; the walk against a full search."""
import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from zonelens.llm import centroids
from zonelens.llm.common import read

from .conftest import SF


def brute(rows, k=16, dims=64, rounds=3, scale=64):
    """(id, vector) rows -> sorted (id, cluster, distance, cluster inertia, inertia, sha256), in Python integers."""
    own = [(i, [math.floor(scale * c) for c in v]) for i, v in rows
           if v is not None and len(v) == dims and all(c is not None and math.isfinite(c) for c in v)]
    order = sorted(own, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    cents = [x for _, x in order[:k]]

    def best(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(cents))

    for _ in range(rounds):
        parts = {}
        for _, x in own:
            parts.setdefault(best(x)[1], []).append(x)
        for j, xs in parts.items():
            cents[j] = [sum(col) // len(xs) for col in zip(*xs)]
    to = [(i, *best(x)) for i, x in own]
    inertia = {}
    for _, d, j in to:
        inertia[j] = inertia.get(j, 0) + d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted(((i, j, d, inertia[j], sum(inertia.values()), sha[j]) for i, d, j in to), key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_embeddings_match_brute_force(spark):
    rows = [(r.vec_id, list(r.embedding)) for r in read(spark, SF, "embeddings").collect()]
    got = entry.queries()["op12_centroids"](spark, SF)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert result(got) == brute(rows)


def test_walk_stops_early_and_loses_nothing():
    rng = np.random.default_rng(3)
    cents = rng.integers(-1000, 1000, (200, 4))
    cents[50:60] = cents[:10]  # equal centroids: the smaller number
    x = np.concatenate([cents[rng.integers(0, 200, 500)] + rng.integers(-20, 20, (500, 4)), rng.integers(-3000, 3000, (100, 4))])
    who, far, measured = centroids.nearest(x, cents, *centroids.sorted_lists(cents))
    full = ((x[:, None, :] - cents[None]) ** 2).sum(2)
    assert (who == full.argmin(1)).all() and (far == full.min(1)).all()
    assert measured < 0.5 * full.size


def test_ties_that_the_frontier_only_equals():
    cents = np.array([[5, 0], [0, 5], [-5, 0], [0, -5], [3, 4], [9, 9]])
    who, far, _ = centroids.nearest(np.array([[0, 0], [9, 9], [4, 2]]), cents, *centroids.sorted_lists(cents))
    assert list(who) == [0, 5, 0] and list(far) == [25, 0, 5]


def test_edge_cases(spark):
    rng = random.Random(4)
    vec = lambda d=4: [rng.uniform(-2, 2) for _ in range(d)]
    same = vec()
    rows = [(1, None), (2, []), (3, vec(3)), (4, [1.0, None, 2.0, 3.0]), (5, [float("nan")] * 4), (6, [float("inf"), 0.0, 0.0, 0.0]),
            (None, vec()), (7, [-0.0, 0.0, -1e-9, 1e-9]), *[(8, same)] * 40, *[(i, vec()) for i in range(10, 60)]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit("other") for c in ("x", "cluster", "h", "distance")})
    for k in (1, 5, 500):
        rows_, cents = centroids.cluster(df, k=k, dims=4)
        assert result(rows_) == brute(rows, k=k, dims=4) and len(cents) == min(k, 92)
    empty, cents = centroids.cluster(df.limit(0), dims=4)
    assert empty.collect() == [] and cents == [] and empty.columns == rows_.columns
    wide = spark.createDataFrame([(1, [1e12] * 4), (2, [0.0] * 4)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="do not fit a long"):
        centroids.cluster(wide, dims=4)[0].collect()
