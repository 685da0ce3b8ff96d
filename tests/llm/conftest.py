import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text[, source]) rows, with extra columns whose names clash."""

    def make(rows):
        rows = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), "x", 1) for r in rows]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, size string, m int")

    return make
