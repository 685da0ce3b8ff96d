"""Approximate nearest neighbours by a hash-prefix forest.

Every tree has its own random hyperplanes; the signs of a vector's products with them are its
hash string of ``BITS`` bits, and a tree is the sorted array of these strings.  A query descends
in every tree to the longest prefix that it shares with an entry there (a binary search and its
two neighbours); then all trees ascend together, one bit at a time, taking the entries that
share the shorter prefix, until enough candidates are found.  Of the last bit only as many trees
are taken as are needed.  Candidates are measured by their exact cosine.

How many candidates are enough (as a share of the rows of a block) is fitted on a bounded sample
of ``SAMPLE`` rows: the smallest share of ``SHARES`` at which the sample's own queries find
``RECALL`` of their neighbours.  The index holds every row.

Scale: rows stay where the scan puts them.  A task gathers ``BLOCK`` rows, builds their forest in
its memory, searches it for a bounded block of queries that all tasks have as a broadcast
(``QUERIES`` rows), and returns the nearest of each; the nearest of all blocks follow from one
small shuffle.  More queries take further passes.  A prefix that very many rows share costs no
more than the block."""
from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ship, stored

TREES, BITS = 24, 32
#: Rows of a forest; rows of a task are cut into blocks of at most so many.
BLOCK = 8192
#: Queries that are sent to all tasks at a time.
QUERIES = 20_000
#: Rows and queries of the sample on which the share of candidates is fitted, and the recall asked for there.
SAMPLE, SAMPLE_QUERIES, RECALL = 8192, 256, 0.97
#: Candidates of a query as shares of a block, trees counted apart; the last one is every row.
SHARES = (1 / 64, 1 / 16, 1 / 4, 1 / 2, 1.0, 1.5, 2.0, 3.0, 4.0, 6.0, 8.0, 12.0, TREES)
#: A query takes at least so many candidates of a block; blocks of no more rows are taken whole.
LEAST = 512


def planes(dims: int, trees: int = TREES, bits: int = BITS, seed: int = 7) -> np.ndarray:
    return np.random.default_rng([seed, dims]).standard_normal((trees * bits, dims))


def strings(unit: np.ndarray, normals: np.ndarray, bits: int = BITS) -> np.ndarray:
    """trees x rows: the hash strings as integers, first bit highest."""
    signs = (unit @ normals.T > 0).reshape(len(unit), -1, bits)
    return (signs.astype(np.uint64) << np.arange(bits - 1, -1, -1, dtype=np.uint64)).sum(2, dtype=np.uint64).T


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times a power of two each, so that squares neither overflow nor vanish; cosines stay exactly."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1))[1][:, None])


def norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(1))


class Forest:
    """The sorted hash strings of a block of rows, in every tree."""

    def __init__(self, ids: list, x: np.ndarray, normals: np.ndarray, bits: int = BITS):
        self.ids, self.x, self.bits = ids, scaled(x), bits
        self.norm = norms(self.x)
        self.unit = self.x / self.norm[:, None]
        codes = strings(self.unit, normals, bits)
        self.order = np.argsort(codes, axis=1, kind="stable")
        self.codes = np.take_along_axis(codes, self.order, 1)

    def descend(self, q: np.ndarray) -> np.ndarray:
        """Length of the longest prefix of each query string that an entry shares, trees x queries."""
        out = np.zeros(q.shape, np.int64)
        last = self.codes.shape[1] - 1
        for t in range(len(q)):
            at = np.searchsorted(self.codes[t], q[t])
            for near in (np.clip(at, 0, last), np.clip(at - 1, 0, last)):
                apart = q[t] ^ self.codes[t][near]
                width = np.frexp(apart.astype(np.float64))[1]  # bits from the first that differs on; up to 53 bits exactly
                out[t] = np.maximum(out[t], self.bits - width)
        return out

    def ranges(self, q: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Where the entries that share the first ``level`` bits stand in each tree's array."""
        rest = np.uint64((1 << (self.bits - level)) - 1)
        lo, hi = q & ~rest, q | rest
        return (np.stack([np.searchsorted(self.codes[t], lo[t]) for t in range(len(q))]),
                np.stack([np.searchsorted(self.codes[t], hi[t], side="right") for t in range(len(q))]))

    def ascend(self, q: np.ndarray, enough: int) -> tuple[np.ndarray, np.ndarray]:
        """(start, stop), trees x queries: the stretches of entries that the trees, ascending together from
        the longest match of any, hold when they have ``enough`` entries."""
        first = self.descend(q).max(0)
        start, stop = np.zeros(q.shape, np.int64), np.zeros(q.shape, np.int64)
        open_ = np.ones(q.shape[1], bool)
        for level in range(int(first.max(initial=0)), -1, -1):
            live = np.flatnonzero(open_ & (first >= level))
            if not len(live):
                continue
            lo, hi = self.ranges(q[:, live], level)
            held = (stop - start)[:, live]
            so_far = held.sum(0) + np.cumsum(hi - lo - held, axis=0)  # with the trees up to this one gone up
            take = (so_far - (hi - lo - held)) < enough
            start[:, live] = np.where(take, lo, start[:, live])
            stop[:, live] = np.where(take, hi, stop[:, live])
            open_[live[so_far[-1] >= enough]] = False
        return start, stop

    def search(self, qids: list, qx: np.ndarray, codes: np.ndarray, k: int, enough: int):
        """(query's place, row, cosine) of the ``k`` nearest candidates of each query, without rows of its own id."""
        qx = scaled(qx)
        qn = norms(qx)
        start, stop = self.ascend(codes, enough)
        for i, qid in enumerate(qids):
            met = np.zeros(len(self.ids), bool)
            for t in range(len(codes)):
                met[self.order[t, start[t, i]:stop[t, i]]] = True
            rows = np.flatnonzero(met)
            near = self.unit[rows] @ (qx[i] / qn[i])
            # the product only narrows the choice: cosines are measured row by row, so that equal rows get equal ones
            want = k + 1
            while True:
                some = rows if want >= len(rows) else rows[near >= np.partition(near, -want)[-want] - 1e-9]
                other = [r for r in some if self.ids[r] != qid]
                if len({self.ids[r] for r in other}) >= k or len(some) == len(rows):
                    break
                want *= 4
            other = np.array(other, np.int64)
            cos = (self.x[other] * qx[i]).sum(1) / (self.norm[other] * qn[i])
            seen = set()
            for j in np.lexsort((np.array([self.ids[r] for r in other]), -cos)) if len(other) else ():
                pair = (self.ids[other[j]], cos[j])
                if pair not in seen:
                    seen.add(pair)
                    yield i, int(other[j]), float(cos[j])
                    if len(seen) == k:
                        break


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, x) of the rows with an id and a vector that is finite and not zero."""
    v = F.transform(F.col(vec_col), lambda c: c.cast("double"))
    odd = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = df.filter(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & ~odd & F.exists(v, lambda c: c != 0))
    return rows.select(F.col(id_col).alias("id"), v.alias("x"))


def matrices(rows: list[tuple]) -> dict[int, tuple[list, np.ndarray]]:
    """(id, vector) rows by the vectors' length: only vectors of equal length have a cosine."""
    by: dict[int, dict] = {}
    for i, x in rows:
        by.setdefault(len(x), {})[i, tuple(x)] = x
    return {d: ([i for i, _ in own], np.array(list(own.values()), np.float64)) for d, own in by.items()}


def wanted(share: float, rows: int) -> int:
    """Candidates that a query takes of a block, trees counted apart; small blocks are taken whole."""
    return TREES * rows if rows <= LEAST else max(LEAST, math.ceil(share * rows))


def fitted_share(sample: list[tuple], k: int, recall: float = RECALL, queries: int = SAMPLE_QUERIES) -> float:
    """The smallest of ``SHARES`` at which queries from the sample find ``recall`` of their ``k`` nearest in it."""
    share = SHARES[0]
    for d, (ids, x) in matrices(sample).items():
        if len(ids) <= max(LEAST, k):
            continue
        normals, q = planes(d), np.linspace(0, len(ids) - 1, min(queries, len(ids))).astype(int)
        forest = Forest(ids, x, normals)
        codes, mine = strings(forest.unit[q], normals), [ids[i] for i in q]
        found_at = lambda s: {(i, j) for i, j, _ in forest.search(mine, x[q], codes, k, wanted(s, len(ids)))}
        true = found_at(SHARES[-1])
        share = next(s for s in SHARES if s >= share and len(found_at(s) & true) >= recall * len(true))
    return share


def search(df: DataFrame, queries: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", *, k: int = 5,
           share: float | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows of ``df`` found for every row of
    ``queries``, by falling cosine, ties to the smaller id; rows of the query's own id are left out.

    Rows without id and vectors that are null, zero, or hold null or non-finite components take no part, as row or
    query; vectors are compared with those of their own length; rows of equal id and vector count once; queries of
    equal id and different vectors are queries of their own; a query with fewer than ``k`` others gets all;
    empty tables give an empty result.  ``share`` (see SHARES) is fitted on a sample if not given."""
    kind = df.schema[id_col].dataType.simpleString()
    rows = usable(df, id_col, vec_col)
    spark = df.sparkSession
    if share is None:
        sample = rows.orderBy(F.xxhash64("id", "x"), "id").limit(SAMPLE).collect()
        share = fitted_share([(r["id"], r["x"]) for r in sample], k)
    asked = stored(usable(queries, id_col, vec_col).distinct().withColumn("h", F.xxhash64("id", "x")), "forest-queries")
    n_blocks = max(1, math.ceil(asked.count() / QUERIES))
    found = None
    for b in range(n_blocks):
        mine = asked.filter(F.pmod("h", F.lit(n_blocks)) == b).collect()
        sent = spark.sparkContext.broadcast(hashed(mine))
        hits = stored(rows.mapInArrow(_searcher(sent, k, share), f"query_id {kind}, form long, vec_id {kind}, score double"), "forest-hits")
        found = hits if found is None else found.unionByName(hits)
    best = Window.partitionBy("query_id", "form").orderBy(F.col("score").desc(), "vec_id")
    found = found.groupBy("query_id", "form", "vec_id", "score").agg(F.count(F.lit(1)).alias("c"))
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def hashed(asked: list) -> dict[int, tuple]:
    """(ids, names, vectors, hash strings) of the queries by the vectors' length; ``h`` names a query."""
    by: dict[int, list] = {}
    for r in asked:
        by.setdefault(len(r["x"]), []).append(r)
    out = {}
    for d, own in by.items():
        x = np.array([r["x"] for r in own], np.float64)
        unit = scaled(x) / norms(scaled(x))[:, None]
        out[d] = [r["id"] for r in own], [r["h"] for r in own], x, strings(unit, planes(d))
    return out


def _searcher(sent, k: int, share: float):
    def block(rows, id_type):
        out = {"query_id": [], "form": [], "vec_id": [], "score": []}
        for d, (ids, x) in matrices(rows).items():
            if d not in sent.value:
                continue
            qids, forms, qx, codes = sent.value[d]
            forest = Forest(ids, x, planes(d))
            for i, r, cos in forest.search(qids, qx, codes, k, wanted(share, len(ids))):
                out["query_id"].append(qids[i]), out["form"].append(forms[i]), out["vec_id"].append(ids[r]), out["score"].append(cos)
        return pa.RecordBatch.from_arrays([pa.array(out["query_id"], id_type), pa.array(out["form"], pa.int64()),
                                           pa.array(out["vec_id"], id_type), pa.array(out["score"], pa.float64())], names=list(out))

    def run(batches):
        rows, id_type = [], None
        for b in batches:
            id_type, i = b.schema.field(0).type, 0
            while i < b.num_rows:
                part = b.slice(i, BLOCK - len(rows))
                rows += zip(part.column(0).to_pylist(), part.column(1).to_pylist())
                i += part.num_rows
                if len(rows) == BLOCK:
                    yield block(rows, id_type)
                    rows = []
        if rows:
            yield block(rows, id_type)

    return run


ship(__name__)
