"""Token counts from flat, unindexed token files by a separator scan.

A flat file is nothing but token identifiers of fixed width, an end-of-document identifier
after each document.  Files are cut into blocks at fixed offsets, wherever documents begin or
end; each block is searched for the identifier in one vector comparison; and the blocks of a
file are stitched by a prefix scan over their summaries (how many ends came before, and
where the last one was), so a document may span any number of blocks.

Scale: writing is narrow (tokenise and append, through Spark's own file commit), scanning reads
byte ranges of bounded size, and only one small row a block and one a document are shuffled.
Nothing depends on the size of a file."""
from __future__ import annotations

import base64
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import checkpointed, ship

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
EOD = 50256
WIDTH = 2  # bytes an identifier, little-endian
BLOCK_BYTES = 8 << 20
# Fixed value: the word pattern that belongs to this vocabulary
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def encoder(ranks: dict[bytes, int]):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def vocabulary(path: str) -> dict[bytes, int]:
    """The ranks of a tiktoken file (bounded: one vocabulary)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def write_flat(docs: DataFrame, path: str, text_col: str = "text", *, vocabulary_path: str = VOCABULARY, eod: int = EOD,
               width: int = WIDTH) -> None:
    """Tokenise every whole text and write one flat file a partition, texts in partition order.
    Null and empty texts are documents of no tokens.

    Spark's text writer appends the end-of-document identifier as its line separator."""
    ranks = docs.sparkSession.sparkContext.broadcast(vocabulary(vocabulary_path))
    if max(ranks.value.values()) >= 1 << 8 * width or eod >= 1 << 8 * width or eod in ranks.value.values():
        raise ValueError("the end-of-document identifier is a token, or identifiers don't fit the width")

    def run(batches):
        enc = encoder(ranks.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([np.array(enc.encode_ordinary(t.as_py() or ""), f"<u{width}").tobytes() for t in b.column(0)],
                                                       pa.binary())], names=["value"])

    flat = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "value binary")
    (flat.select(F.col("value").cast("string")).write.option("encoding", "ISO-8859-1")
     .option("lineSep", eod.to_bytes(width, "little").decode("latin-1")).text(path))


def blocks(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES, width: int = WIDTH) -> DataFrame:
    """(path, block, at, size) of all flat files below ``path``, in bytes; the files are listed, not read."""
    step = max(1, block_bytes // width) * width
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length").filter("length > 0")
    files = files.withColumn("rest", F.col("length") % width)
    files = files.withColumn("length", F.when(F.col("rest") == 0, F.col("length")).otherwise(
        F.raise_error(F.concat(F.col("path"), F.lit(" isn't made of whole identifiers"))).cast("long")))
    at = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(step).cast("long")))
    cut = files.select("path", "length", at.alias("at"))
    return cut.select("path", (F.col("at") / step).cast("long").alias("block"), "at", F.least(F.lit(step).cast("long"), F.col("length") - F.col("at")).alias("size"))


def ends(cut: DataFrame, eod: int = EOD, width: int = WIDTH) -> DataFrame:
    """(path, block, tokens, ends): of each block its tokens and where in the file, in tokens, its
    end-of-document identifiers stand."""

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                fs, name = pyarrow.fs.FileSystem.from_uri(r["path"])
                with fs.open_input_file(name) as f:
                    ids = np.frombuffer(f.read_at(r["size"], r["at"]), f"<u{width}")
                found = np.flatnonzero(ids == eod) + r["at"] // width
                yield pa.RecordBatch.from_arrays([pa.array([r["path"]]), pa.array([r["block"]], pa.int64()), pa.array([len(ids)], pa.int64()),
                                                  pa.array([found], pa.list_(pa.int64()))], names=["path", "block", "tokens", "ends"])

    # blocks are dealt evenly, so that one large file is read by many tasks
    n = int(cut.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut.repartition(n, "path", "block").mapInArrow(run, "path string, block long, tokens long, ends array<long>")


def documents(found: DataFrame) -> DataFrame:
    """(path, ordinal, n_tokens, closed) of every document of every file, ordinals from 0; what
    stands after a file's last end is a document that isn't closed."""
    order = Window.partitionBy("path").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    last = F.when(F.size("ends") > 0, F.element_at("ends", -1))
    scan = (found.withColumn("base", F.coalesce(F.sum(F.size("ends")).over(before), F.lit(0)))
            .withColumn("previous", F.coalesce(F.last(last, ignorenulls=True).over(before), F.lit(-1)))
            .withColumn("upto", F.sum("tokens").over(order))
            .withColumn("final", F.lead("block").over(order).isNull()))
    starts = F.concat(F.array("previous"), F.col("ends"))
    closed = scan.select("path", F.posexplode(F.zip_with("ends", F.slice(starts, 1, F.greatest(F.size("ends"), F.lit(1))), lambda e, s: e - s - 1)).alias("i", "n_tokens"), "base")
    closed = closed.filter("n_tokens is not null").select("path", (F.col("base") + F.col("i")).alias("ordinal"), "n_tokens", F.lit(True).alias("closed"))
    at = F.coalesce(last, F.col("previous"))
    tail = scan.filter("final").select("path", (F.col("base") + F.size("ends")).alias("ordinal"), (F.col("upto") - at - 1).alias("n_tokens"), F.lit(False).alias("closed"))
    return closed.unionByName(tail.filter("n_tokens > 0"))


def scan_files(spark: SparkSession, path: str, *, eod: int = EOD, width: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents of all flat files below ``path``: (path, ordinal, n_tokens, closed).  Files without a
    byte have no documents; a folder without files gives an empty result."""
    return documents(ends(blocks(spark, path, block_bytes, width), eod, width))


@contextmanager
def same_splits(spark: SparkSession):
    """While this holds, a scan is cut alike whatever executors come or go: unless a number is
    set, Spark derives the size of a scan's splits from the cores present when it is planned."""
    name = "spark.sql.files.minPartitionNum"
    ours = spark.conf.get(name, None) is None
    if ours:
        spark.conf.set(name, str(max(1, spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        if ours:
            spark.conf.unset(name)


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", *, vocabulary_path: str = VOCABULARY,
                 eod: int = EOD, width: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id, n_tokens) of every row of ``docs``, counted in the flat files written below ``path``.

    File k holds the texts of partition k in their order, so (k, ordinal) names the row; ``docs``
    must come straight from a table (with :func:`same_splits` a scan deals its rows out alike each
    time; a row without its document in the files fails the job).  Null and empty
    texts count 0, repeated rows count each, null ids are kept; other columns are not read.  An
    empty table gives an empty result."""
    spark = docs.sparkSession
    with same_splits(spark):
        write_flat(docs, path, text_col, vocabulary_path=vocabulary_path, eod=eod, width=width)
        places = checkpointed(numbered(docs, id_col))
    return named(places, scan_files(spark, path, eod=eod, width=width, block_bytes=block_bytes))


def numbered(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, place) of every row: partition << 33 | row of the partition."""
    return docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("place"))


def named(places: DataFrame, found: DataFrame) -> DataFrame:
    """(id, n_tokens): the rows of :func:`numbered` with the documents of the files of their
    partitions."""
    part = F.regexp_extract("path", r"part-(\d+)[^/]*$", 1).cast("long")
    counted = found.select(F.shiftleft(part, 33).bitwiseOR(F.col("ordinal")).alias("place"), "n_tokens")
    missing = F.raise_error(F.lit("a row has no document in the token files: docs must come straight from a table")).cast("long")
    return places.join(counted, "place", "left").select("id", F.coalesce("n_tokens", missing).alias("n_tokens"))


ship(__name__)
