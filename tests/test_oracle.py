"""Every registered query with an oracle against DuckDB on the smallest driver tables."""
import math
import os

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ["events", "orders", "lineitem", "embeddings", "documents", "labels"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return str(v).replace("T", " ")
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t + '.parquet')}')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    got = _rows(E.queries()[name](spark, SF).toPandas())
    want = _rows(con.sql(E.oracle_sql()[name]).df())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["district", "dominant_measure", "dominant_value"]
    assert df.count() > 0
