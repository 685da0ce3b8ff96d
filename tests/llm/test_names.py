"""Columns of the caller named as the operators' own ones, in other letter case too: no crash, every value kept."""
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from zonelens.llm import decontam, linededup, mixing, quality, simhash, spans
from zonelens.llm.common import stored

TEXT = "This is the only text that stands here, and it is long enough to pass every rule of quality, as a text should be.\nIt has two lines."
OWN = ("_t", "_w", "_L", "_j", "_m", "_m0", "fails", "M", "_keep", "_bad", "_cut", "key", "row", "text_", "N_LINES", "n_removed",
       "n_sentences", "words_removed", "lost", "sides", "count", "fp", "root", "rep", "Size", "q", "p", "bucket", "picks", "target", "a.b")


@pytest.fixture(scope="module")
def clashing(spark):
    docs = spark.createDataFrame([(1, TEXT, "en", "s"), (2, None, "en", None), (3, "short", "fr", "s")], "doc_id long, text string, lang string, source string")
    return docs.select("*", *[F.lit(f"own {c}").alias(c) for c in OWN])


def kept(out, new=()):
    """Each of the caller's columns that is not replaced is there once, with its value."""
    names = [c for c in OWN if c.lower() not in new]
    assert [c for c in out.columns if c in names] == names
    assert len({c.lower() for c in out.columns}) == len(out.columns)
    rows = out.collect()
    assert all(r[c] == f"own {c}" for r in rows for c in names)
    return rows


@pytest.mark.parametrize("apply,new", [
    (quality.ledger, ("fails", "m")), (lambda d: quality.passing(d, "base", "v2"), ()),
    (linededup.strip_boilerplate, ("n_lines", "n_removed")), (lambda d: linededup.strip_boilerplate(d, counts=False), ()),
    (simhash.keep_one, ()), (lambda d: spans.dedup_spans(d, extend=True), ("n_sentences", "n_removed", "words_removed")),
    (lambda d: mixing.apply_cuts(d, mixing.mix(d)[1]), ("size", "source_size", "target"))])
def test_operators_keep_clashing_columns(clashing, apply, new):
    rows = kept(apply(clashing), new)
    assert rows and all(r.text in (TEXT, "short", None) for r in rows)


def test_decontamination_keeps_clashing_columns(spark, clashing):
    items = spark.createDataFrame([(1, "no such words stand anywhere")], "item_id long, text string")
    assert len(kept(decontam.drop_contaminated(clashing, items))) == 3


def test_stages_keep_clashing_columns(spark, clashing):
    items = "file:///root/testdata/sf0.001"
    docs = clashing.drop("a.b")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stored(stage(spark, docs, items), f"names-{k}")
        assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        docs = out
    assert [(r.doc_id, r.text, r.M, r.N_LINES, r.fails) for r in docs.collect()] == [(1, TEXT, "own M", "own N_LINES", "own fails")]
