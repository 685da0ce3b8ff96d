"""The pipeline's stages against brute force on the smallest documents, and the queries' SQL."""
import duckdb
import pytest

import corpus_pipeline
from zonelens.llm import decontam, mixing, queries, quality
from zonelens.llm.common import read, stored

from . import test_decontam, test_linededup, test_quality, test_simhash
from .conftest import SF


def test_stages_match_brute_force(spark):
    docs = read(spark, SF, "documents")
    names = docs.columns
    rows = {r.doc_id: r.asDict() for r in docs.collect()}

    def step(k, docs):
        out = stored(corpus_pipeline.STAGES[k][1](spark, docs, SF), "test")
        assert k == 4 or out.columns == names
        return out, {r.doc_id: r.asDict() for r in out.collect()}

    one, got = step(0, docs)
    fails = {r.doc_id: r.fails for r in quality.ledger(docs).collect()}
    assert set(got) == {i for i in rows if not fails[i] & quality.mask("v2")}
    for i, r in rows.items():
        n, _, _, _, rep = test_quality.brute(r["text"])
        assert i not in got or n >= 20 and 100 * rep <= 30 * n
    two, after = step(1, one)
    want = test_linededup.brute([(i, r["text"], r["source"]) for i, r in got.items()], 10)
    assert sorted(((i, r["text"]) for i, r in after.items()), key=str) == sorted(((x[0], x[3]) for x in want), key=str)
    three, kept = step(2, two)
    fps = [(i, test_simhash.brute_fingerprint(r["text"])) for i, r in sorted(after.items())]
    assert set(kept) == set(test_simhash.brute_components(fps))
    four, clean = step(3, three)
    items = [decontam.tokens(r.text) for r in read(spark, SF, "benchmark").collect()]
    leaked = set()
    for i, r in kept.items():
        words = decontam.tokens(r["text"])
        have = set(words)
        for item in items:
            e = int(len(item) * decontam.MAX_ERROR)
            if sum(w not in have for w in item) <= e and test_decontam.brute(item, words) <= e:
                leaked.add(i)
    assert set(clean) == set(kept) - leaked
    _, mixed = step(4, four)
    copies = {r.id: r.copies for r in mixing.mix(four)[0].collect()}
    assert {i: r["copies"] for i, r in mixed.items()} == {i: c for i, c in copies.items() if c > 0}


def test_run_and_empty_input(spark, tmp_path):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and {"doc_id", "text", "copies"} <= set(out.columns)
    read(spark, SF, "documents").limit(0).write.parquet(f"file://{tmp_path}/documents.parquet")
    read(spark, SF, "benchmark").write.parquet(f"file://{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, f"file://{tmp_path}").count() == 0


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_match_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = queries.queries()[name](spark, SF)
    names = sorted(got.columns)
    want = con.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == names
    at = [columns.index(c) for c in names]
    norm = lambda rows: sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in rows), key=repr)
    assert norm(tuple(r) for r in got.select(*names).collect()) == norm(tuple(r[k] for k in at) for r in want.fetchall())


def test_every_operator_has_a_query(spark):
    names = queries.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14)) and "pipeline" in names
