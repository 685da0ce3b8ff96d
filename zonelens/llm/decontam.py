"""Benchmark decontamination by pigeonhole edit matching.

Test items and documents are compared as sequences of words (A-Z and all other letters
lower-cased, punctuation dropped).  An item of n words has an error budget of
e = floor(n * max_error) word edits and is split into e + 1 pieces; a passage within e edits
holds at least one piece unchanged.  Exact piece hits are found in one pass over each text, and
every hit is verified by Myers' bit-parallel distance of the whole item against the stretch of
text around it, so the answer is complete: every document that holds an item within its
budget is found.

Scale: the items are a stated query set.  Their pieces are cut into blocks of at most
``block_words`` item words each, only one block at a time is sent to the tasks (its size is thus
bounded whatever the benchmark's), and the documents are read narrowly, without any shuffle.
A text is scanned by looking its words up in the block's vocabulary; hits of one item in one
text that overlap are verified once."""
from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import row_key, ship

MAX_ERROR = 0.15
MIN_WORDS = 1
BLOCK_WORDS = 2_000_000
WORD = re.compile(r"[^\W_]+")


def tokens(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def pieces(n: int, max_error: float = MAX_ERROR) -> list[tuple[int, int]]:
    """(start, stop) of the e + 1 nearly equal pieces of an item of n words."""
    parts = int(n * max_error) + 1
    return [(n * k // parts, n * (k + 1) // parts) for k in range(parts)]


def myers(item: list, text: list) -> tuple[int, int]:
    """(distance, end): the least edit distance of ``item`` to any stretch of ``text`` and where the
    first such stretch ends, by Myers' bit-parallel columns on whole integers."""
    m = len(item)
    peq: dict = {}
    for k, w in enumerate(item):
        peq[w] = peq.get(w, 0) | 1 << k
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best = full, 0, m, (m, 0)
    for j, w in enumerate(text):
        eq = peq.get(w, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        score += bool(ph & top) - bool(mh & top)
        ph, mh = ph << 1 & full, mh << 1 & full  # a free start: row 0 is all zero
        pv, mv = mh | ~(xv | ph) & full, ph & xv
        if score < best[0]:
            best = (score, j + 1)
    return best


class Items:
    """One block of test items, ready to be looked up."""

    def __init__(self, items: list[tuple], max_error: float):
        self.items = [(i, words) for i, words in items]
        self.budget = [int(len(w) * max_error) for _, w in self.items]
        self.starts: dict[str, dict[int, dict[tuple, list]]] = {}  # first word -> length -> piece -> places
        for k, (_, words) in enumerate(self.items):
            for a, b in pieces(len(words), max_error):
                self.starts.setdefault(words[a], {}).setdefault(b - a, {}).setdefault(tuple(words[a:b]), []).append((k, a))

    def find(self, words: list[str]) -> dict[int, tuple[int, int, int]]:
        """item -> (distance, first word, end) of its best passage among ``words``."""
        windows: dict[int, list] = {}
        starts = self.starts
        for at, w in enumerate(words):
            if w in starts:
                for n, table in starts[w].items():
                    for k, a in table.get(tuple(words[at:at + n]), ()):
                        e, m = self.budget[k], len(self.items[k][1])
                        lo, hi = max(0, at - a - e), min(len(words), at - a + m + e)
                        old = windows.setdefault(k, [])
                        if old and lo <= old[-1][1]:
                            old[-1] = (min(lo, old[-1][0]), max(hi, old[-1][1]))
                        else:
                            old.append((lo, hi))
        out = {}
        for k, stretches in windows.items():
            item = self.items[k][1]
            for lo, hi in stretches:
                d, end = myers(item, words[lo:hi])
                if d <= self.budget[k] and (k not in out or d < out[k][0]):
                    # the start, from the same distance read backwards
                    _, back = myers(item[::-1], words[lo:lo + end][::-1])
                    out[k] = (d, lo + end - back, lo + end)
                    if d == 0:
                        break
        return out


def blocks(benchmark: DataFrame, item_col: str, text_col: str, min_words: int, block_words: int):
    """The items as lists of (id, words), each list of at most ``block_words`` words or one item.
    Rows come to the driver one partition at a time and leave it with their block."""
    block, size = [], 0
    for r in benchmark.select(F.col(item_col).alias("i"), F.col(text_col).alias("t")).toLocalIterator():
        words = tokens(r["t"])
        if len(words) < min_words:
            continue
        if block and size + len(words) > block_words:
            yield block
            block, size = [], 0
        block.append((r["i"], words))
        size += len(words)
    if block:
        yield block


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
            item_text_col: str = "text", *, max_error: float = MAX_ERROR, min_words: int = MIN_WORDS,
            block_words: int = BLOCK_WORDS) -> DataFrame:
    """(id, key, item, distance, first_word, end_word): one row for each row of ``docs`` and each
    item that it holds within the item's budget, with the best passage (the earliest of equals).

    ``key`` is the row's key.  Items of fewer than ``min_words`` words (by default those without a
    word) match nothing; an item of few words has no error budget and matches where it stands word for word; null and empty texts hold nothing; equal items match each under
    its id; repeated rows match each; empty tables give an empty result; other columns are not
    read."""
    kind, item_kind = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_col].dataType.simpleString()
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    schema = f"id {kind}, key long, item {item_kind}, distance int, first_word int, end_word int"

    def search(block):
        shared = spark.sparkContext.broadcast(block)

        def run(batches):
            items = Items(shared.value, max_error)
            for b in batches:
                id_type = b.schema.field(0).type
                ids, keys, found = [], [], []
                for i, key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                    for k, hit in items.find(tokens(text.as_py())).items():
                        ids.append(i), keys.append(key), found.append((items.items[k][0], *hit))
                cols = list(zip(*found)) or [()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(ids, id_type), pa.array(keys, pa.int64()), pa.array(cols[0], item_type(item_kind)),
                                                  *(pa.array(c, pa.int32()) for c in cols[1:])],
                                                 names=["id", "key", "item", "distance", "first_word", "end_word"])

        return rows.mapInArrow(run, schema)

    out = None
    for block in blocks(benchmark, item_col, item_text_col, min_words, block_words):
        found = search(block)
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], schema) if out is None else out


def item_type(kind: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32()}.get(kind, pa.string())


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns, in one narrow pass for each
    block of items (no shuffle)."""
    names = docs.columns
    docs = docs.toDF(*[f"c{i}" for i in range(len(names))])  # names that no struct path is read from
    schema = docs.schema
    max_error, min_words = how.get("max_error", MAX_ERROR), how.get("min_words", MIN_WORDS)
    sc = docs.sparkSession.sparkContext

    def clean(df, block):
        shared = sc.broadcast(block)

        def run(batches):
            items = Items(shared.value, max_error)
            for b in batches:
                keep = [not items.find(tokens(t.as_py())) for t in b.column(names.index(text_col))]
                yield b.filter(pa.array(keep, pa.bool_()))

        return df.mapInArrow(run, schema)

    for block in blocks(benchmark, how.get("item_col", "item_id"), how.get("item_text_col", "text"), min_words, how.get("block_words", BLOCK_WORDS)):
        docs = clean(docs, block)
    return docs.toDF(*names)


ship(__name__)
