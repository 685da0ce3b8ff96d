"""SimHash near-duplicate groups by multi-index hashing.

Fingerprint: lower-cased words, 4-word shingles with repeats, XXH64 (seed 42) of each; a bit
is set where more than half the hashes have it.  Links: two fingerprints within
``max_bits`` differing bits.  The 64 bits are cut into ``segments`` pieces; by the
pigeonhole principle two linked fingerprints agree in one of the first ``a + 1`` pieces up
to ``q`` bits or in a later one up to ``q - 1`` bits (``max_bits = segments * q + a``).
So each distinct fingerprint is stored once under each piece and looked up once under every
value in the small Hamming ball around each piece; each match is verified on all 64 bits.

Scale: exact copies collapse before the index (one entry per distinct fingerprint, with
partial aggregation), the lookup is an equi-join whose condition (distance, orientation,
first matching piece) runs inside the join, so only true links come out and each of them
once; hot buckets are split by adaptive skew handling, and links become components by star
rounds.  Pieces should have about log2(distinct fingerprints) bits: three pieces (21-22
bits) suit up to some 10^9 fingerprints, two pieces beyond."""
from __future__ import annotations

from itertools import combinations, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, own, row_key, ship, unused
from .components import components

#: Shingles hashed at a time: bounds the memory of a very long text.
BLOCK = 1 << 16


def fingerprint(text: bytes | None, shingle: int = 4) -> int:
    """SimHash of one whole text as a signed 64-bit integer; 0 for texts without words."""
    ws = (text or b"").lower().split()  # bytes: ASCII letters and ASCII white space only
    if not ws:
        return 0
    if len(ws) < shingle:
        grams, n = iter([ws]), 1
    else:
        grams, n = zip(*(ws[k:] for k in range(shingle))), len(ws) - shingle + 1
    h, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    while block := [h(b" ".join(g), 42) for g in islice(grams, BLOCK)]:
        ones += np.unpackbits(np.array(block, ">u8").view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n).view(">i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """(row id, key, fp) of every row; ``key`` tells rows of equal id and different text apart."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            texts = b.column(2).cast(pa.binary())
            fps = [fingerprint(t.as_py(), shingle) for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps, pa.int64())], names=["id", "key", "fp"])

    rows = docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, key long, fp long")


def pieces(segments: int, max_bits: int, bits: int = 64) -> list[tuple[int, int, int]]:
    """(shift, width, radius) of the pieces that have to be looked up."""
    q, a = divmod(max_bits, segments)
    out, shift = [], bits
    for k in range(segments):
        width = bits // segments + (k < bits % segments)
        shift -= width
        radius = q if k <= a else q - 1
        if radius >= 0:
            out.append((shift, width, radius))
    return out


def balls(width: int, radius: int) -> list[int]:
    """All masks of at most ``radius`` set bits."""
    return [sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(width), r)]


def _long(x: int) -> Column:
    """A 64-bit pattern as Spark's signed long."""
    return F.lit(x - (1 << 64) if x >> 63 else x).cast("long")


def _piece(fp: Column, shift: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, shift).bitwiseAND(_long((1 << width) - 1))


def links(fps: DataFrame, max_bits: int = 4, segments: int = 3) -> DataFrame:
    """(a, b), a < b: every pair of the distinct fingerprints ``fp`` within ``max_bits`` bits,
    each once."""
    cut = pieces(segments, max_bits)
    fp = F.col("fp")
    entry = lambda k, value: value.bitwiseOR(_long(k << 60))  # noqa: E731  piece number and value in one key
    table = fps.select(fp.alias("b"), F.explode(F.array(*[entry(k, _piece(fp, s, w)) for k, (s, w, _) in enumerate(cut)])).alias("slot"))
    masks = F.array(*[_long(m << s) for s, w, r in cut for m in balls(w, r)])
    where = F.array(*[F.lit(k) for k, (_, w, r) in enumerate(cut) for _ in balls(w, r)])
    probes = fps.select(fp.alias("a"), F.explode(F.arrays_zip(masks.alias("mask"), where.alias("k"))).alias("p"))
    moved = F.col("a").bitwiseXOR(F.col("p")["mask"])
    slot = F.coalesce(*[F.when(F.col("p")["k"] == k, entry(k, _piece(moved, s, w))) for k, (s, w, _) in enumerate(cut)])
    probes = probes.select("a", slot.alias("slot"), F.col("p")["k"].alias("k"))
    apart = F.col("a").bitwiseXOR(F.col("b"))
    # a pair that an earlier piece finds is left to that piece
    first = F.lit(True)
    for k, (s, w, r) in enumerate(cut):
        first = first & ((F.col("k") <= k) | (F.bit_count(_piece(apart, s, w)) > r))
    close = (F.bit_count(apart) <= max_bits) & (F.col("a") < F.col("b")) & first
    return probes.alias("p").join(table.alias("t"), (F.col("p.slot") == F.col("t.slot")) & close).select("a", "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = 4,
                    max_bits: int = 4, segments: int = 3) -> DataFrame:
    """(id, key, fp, root, component_id) of every row of ``docs``; ``root`` names the group.

    component_id is the smallest id among the rows reachable over links, the row itself
    included (null ids are passed over; null if the whole group has none).  Null and empty
    texts have fingerprint zero and are linked like any other; repeated rows stay repeated;
    an empty table gives an empty result; other columns are not read."""
    fps = checkpointed(fingerprints(docs, id_col, text_col, shingle))
    nodes = checkpointed(fps.groupBy("fp").agg(F.min("id").alias("rep")))
    roots = components(links(nodes, max_bits, segments))
    named = checkpointed(nodes.join(roots, nodes["fp"] == roots["node"], "left").select("fp", "rep", F.coalesce("root", "fp").alias("root")))
    lowest = checkpointed(named.groupBy("root").agg(F.min("rep").alias("component_id")))
    of = named.join(lowest, "root").select("fp", "root", "component_id")
    return fps.join(of, "fp", "left").select("id", "key", "fp", "root", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One row of each near-duplicate group, with all columns of ``docs``: the smallest id,
    of equal ids the smallest key; of rows with equal id and text any one.  Columns of any name stay."""
    rows = near_duplicates(docs, id_col, text_col, **how)
    chosen = rows.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("m"))
    keep, = unused(docs, "_keep")
    chosen = chosen.select(F.col("m.key").alias(keep))
    marked = docs.withColumn(keep, row_key(id_col, text_col))
    return marked.join(chosen, keep, "left_semi").dropDuplicates([keep]).select(*own(docs))


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


ship(__name__)
