"""Centroid clustering of integer vectors, nearest centroids by the threshold algorithm.

Every dimension has the list of the centroids sorted by their value there.  For a vector the
lists are walked outward from its own value, one step in all dimensions at a time: each step
meets some centroids for the first time, whose distances are measured exactly, and the gaps at
the frontier of the walk, squared and summed, bound the distance of every centroid not met yet
from below.  The walk ends when that sum strictly exceeds the best exact distance, so that a
centroid of equal distance and smaller number is never missed.

Scale: the vectors are written once as integers; each round is one narrow pass over them, whose
tasks send one partial sum a centroid and dimension.  The driver holds the centroids only
(``k`` x dimensions).  Tasks work on ``CHUNK`` vectors at a time."""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, stored

#: Vectors that a task measures at a time.
CHUNK = 2048
FAR = np.iinfo(np.int64).max


def sorted_lists(cents: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(values, numbers), each dimensions x (k + 2): the centroids of every dimension by value,
    between two ends that no walk takes."""
    order = np.argsort(cents, axis=0, kind="stable").T
    return np.take_along_axis(cents.T, order, 1), order


def nearest(x: np.ndarray, cents: np.ndarray, values: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(cluster, squared distance) of every row of ``x`` and how many distances were measured;
    ties go to the smaller number."""
    n, (k, d) = len(x), cents.shape
    dims = np.arange(d)
    right = np.stack([np.searchsorted(values[j], x[:, j]) for j in dims], axis=1) if n else np.zeros((0, d), np.int64)
    left = right - 1
    exact = np.full((n, k), FAR)
    live, measured = np.arange(n), 0
    for _ in range(k):
        xs, lo, hi = x[live], left[live], right[live]
        below = np.where(lo >= 0, xs - values[dims, np.maximum(lo, 0)], FAR)
        above = np.where(hi < k, values[dims, np.minimum(hi, k - 1)] - xs, FAR)
        down = below <= above
        met = np.zeros((len(live), k), bool)
        met[np.arange(len(live))[:, None], numbers[dims, np.where(down, np.maximum(lo, 0), np.minimum(hi, k - 1))]] = True
        row, c = np.nonzero(met & (exact[live] == FAR))
        exact[live[row], c] = ((xs[row] - cents[c]) ** 2).sum(1)
        measured += len(row)
        left[live], right[live] = lo - down, hi + ~down
        # the walk has gone one step in every dimension: a centroid not met is as far as its frontier at least
        live = live[(np.minimum(below, above) ** 2).sum(1) <= exact[live].min(1)]
        if not len(live):
            break
    who = exact.argmin(1)
    return who, exact[np.arange(n), who], measured


def limit(dims: int) -> int:
    """The largest integer of a component for which squared distances fit a long."""
    return int((2**62 / dims) ** 0.5) // 2


def _vectors(column: pa.Array, dims: int) -> np.ndarray:
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
    if x.size and np.abs(x).max() > limit(dims):
        raise OverflowError(f"components beyond {limit(dims)}: their squared distances do not fit a long")
    return x


def integers(df: DataFrame, id_col: str, vec_col: str, dims: int, scale: int) -> DataFrame:
    """(id, x): floor(scale * component) of the vectors with exactly ``dims`` finite components."""
    v = F.transform(F.col(vec_col), lambda c: c.cast("double"))
    odd = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    kept = df.filter((F.size(vec_col) == dims) & ~odd)
    return kept.select(F.col(id_col).alias("id"), F.transform(v, lambda c: F.floor(c * scale).cast("long")).alias("x"))


def seeds(kept: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The ``k`` vectors of smallest sha256 of "seed:id", in that order; of equal ids the smaller vector."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    rows = kept.select(F.sha2(name, 256).alias("h"), "x").orderBy("h", "x").limit(k).collect()
    return [list(r["x"]) for r in rows]


def sums(kept: DataFrame, cents: np.ndarray) -> dict[int, tuple[int, list[int]]]:
    """Size and componentwise sum of every cluster that has vectors."""
    k, d = cents.shape

    def run(batches):
        values, numbers = sorted_lists(cents)
        n, total = np.zeros(k, np.int64), np.zeros((k, d), np.int64)
        for b in batches:
            for i in range(0, b.num_rows, CHUNK):
                x = _vectors(b.column(0).slice(i, CHUNK), d)
                who = nearest(x, cents, values, numbers)[0]
                np.add.at(total, who, x)
                n += np.bincount(who, minlength=k)
        own = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.int32()), pa.array(n[own]), pa.array(list(total[own]), pa.list_(pa.int64()))],
                                         names=["cluster", "n", "total"])

    parts = kept.select("x").mapInArrow(run, "cluster int, n long, total array<long>")
    rows = (parts.select("cluster", "n", F.posexplode("total").alias("dim", "part")).groupBy("cluster", "dim")
            .agg(F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect())
    out = {}
    for r in sorted(rows, key=lambda r: (r["cluster"], r["dim"])):
        out.setdefault(r["cluster"], (r["n"], []))[1].append(int(r["total"]))
    return out


def assign(kept: DataFrame, cents: np.ndarray) -> DataFrame:
    """(id, cluster, distance) of every vector."""
    d = cents.shape[1]
    kind = kept.schema["id"].dataType.simpleString()

    def run(batches):
        values, numbers = sorted_lists(cents)
        for b in batches:
            for i in range(0, b.num_rows, CHUNK):
                part = b.slice(i, CHUNK)
                who, far, _ = nearest(_vectors(part.column(1), d), cents, values, numbers)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(who, pa.int32()), pa.array(far, pa.int64())], names=["id", "cluster", "distance"])

    return kept.select("id", "x").mapInArrow(run, f"id {kind}, cluster int, distance long")


def fingerprint(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def cluster(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", *, k: int = 16, dims: int = 64,
            rounds: int = 3, scale: int = 64, seed: int = 1) -> tuple[DataFrame, list[list[int]]]:
    """((id, cluster, distance, cluster_inertia, inertia, centroid_sha256), centroids).

    Vectors that are null, of another length or with a null or non-finite component take no part.
    Rows are not merged: repeated rows are vectors of their own, null ids stay null (and count as empty
    text in the seeds' hash).  Fewer than ``k`` vectors give as many centroids; ties go to the smaller
    number; an empty cluster keeps its centroid; an empty table gives an empty result.  Components so
    large that a squared distance would not fit a long fail the job.  Other columns are not read."""
    kept = stored(integers(df, id_col, vec_col, dims, scale), "centroids-vectors")
    cents = seeds(kept, k, seed)
    none = "cluster_inertia long, inertia long, centroid_sha256 string"
    if not cents:
        empty = kept.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"),
                            *[F.lit(None).cast(c.split()[1]).alias(c.split()[0]) for c in none.split(", ")])
        return empty, []
    for _ in range(rounds):
        for c, (n, total) in sums(kept, np.array(cents, np.int64)).items():
            cents[c] = [t // n for t in total]
    rows = stored(assign(kept, np.array(cents, np.int64)), "centroids-assigned")
    inertia = {r["cluster"]: int(r["s"]) for r in rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    of = lambda values: F.element_at(F.array(*values), F.col("cluster") + 1)
    return rows.select("id", "cluster", "distance",
                       of([F.lit(inertia.get(c, 0)).cast("long") for c in range(len(cents))]).alias("cluster_inertia"),
                       F.lit(sum(inertia.values())).cast("long").alias("inertia"),
                       of([F.lit(fingerprint(c)) for c in cents]).alias("centroid_sha256")), cents


ship(__name__)
