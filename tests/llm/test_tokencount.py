"""Token counts against the tokenizer itself, boundaries across blocks, edge cases."""
import numpy as np
import pytest

from zonelens.llm import tokencount
from zonelens.llm.common import read
from zonelens.session import staging_path

from .conftest import SF


@pytest.fixture(scope="module")
def encode():
    enc = tokencount.encoder(tokencount.vocabulary(tokencount.VOCABULARY))
    return lambda t: len(enc.encode_ordinary(t or ""))


def test_documents_match_the_tokenizer(spark, encode):
    docs = read(spark, SF, "documents")
    want = sorted((r.doc_id, encode(r.text)) for r in docs.collect())
    for block in (64, 4096, tokencount.BLOCK_BYTES):
        got = tokencount.token_counts(docs, staging_path(spark, "t"), block_bytes=block)
        assert sorted((r.id, r.n_tokens) for r in got.collect()) == want


@pytest.mark.parametrize("width", [2, 4])
def test_boundaries_across_blocks(spark, tmp_path, width):
    rng = np.random.default_rng(4)
    want = []
    for f in range(3):
        sizes = rng.integers(0, 40, 50)
        ids = np.concatenate([x for n in sizes for x in (rng.integers(0, 7, n), [7])] + [rng.integers(0, 7, f * 30)]).astype(f"<u{width}")
        (tmp_path / f"file{f}.bin").write_bytes(ids.tobytes())
        want += [(f"file{f}.bin", k, n, True) for k, n in enumerate(sizes)] + ([(f"file{f}.bin", 50, f * 30, False)] if f else [])
    (tmp_path / "none.bin").write_bytes(b"")
    for block in (width, 3 * width, 50 * width + 1, 1 << 20):
        got = tokencount.scan_files(spark, f"file://{tmp_path}", eod=7, width=width, block_bytes=block).collect()
        assert sorted((r.path.rsplit("/", 1)[1], r.ordinal, r.n_tokens, r.closed) for r in got) == sorted(want)


def test_broken_file_fails(spark, tmp_path):
    (tmp_path / "odd.bin").write_bytes(b"abc")
    with pytest.raises(Exception, match="whole identifiers"):
        tokencount.scan_files(spark, f"file://{tmp_path}").collect()


def test_edge_cases(spark, docs_of, encode):
    rows = [(1, None), (2, ""), (3, "same"), (3, "same"), (None, "no id"), (4, "long text " * 50_000), (5, "a" * 200_000), (6, "\n\n 😀 é")]
    path = staging_path(spark, "edge-docs")
    docs_of(rows).write.parquet(path)
    docs = spark.read.parquet(path)
    got = tokencount.token_counts(docs, staging_path(spark, "t"))
    assert sorted((str(r.id), r.n_tokens) for r in got.collect()) == sorted((str(i), encode(t)) for i, t in rows)
    docs_of(rows).limit(0).write.parquet(f"{path}-none")
    assert tokencount.token_counts(spark.read.parquet(f"{path}-none"), staging_path(spark, "t")).count() == 0


def test_splits_are_held_and_misplaced_rows_fail(spark, docs_of):
    name = "spark.sql.files.minPartitionNum"
    with tokencount.same_splits(spark):
        assert spark.conf.get(name) == str(spark.sparkContext.defaultParallelism)
    assert spark.conf.get(name, None) is None
    path = staging_path(spark, "held-docs")
    docs_of([(k, "some words here") for k in range(50)]).write.parquet(path)
    docs = spark.read.parquet(path)
    spark.conf.set(name, "3")
    try:
        with tokencount.same_splits(spark):
            assert spark.conf.get(name) == "3"
        assert tokencount.token_counts(docs, staging_path(spark, "t")).count() == 50
    finally:
        spark.conf.unset(name)
    with pytest.raises(Exception, match="straight from a table"):  # dealt anew, so the files' order isn't the rows'
        flat = staging_path(spark, "t")
        tokencount.write_flat(docs.limit(10), flat)
        tokencount.named(tokencount.numbered(docs), tokencount.scan_files(spark, flat)).collect()
