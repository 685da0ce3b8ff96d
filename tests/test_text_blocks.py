"""Documents encoded by blocks: the words of the plain column form, whatever the blocks, and no row a word."""
import pytest
from pyspark.sql import functions as F

from zonelens.functions import text as T
from zonelens.operators import text as tx

TEXTS = [
    None, "", " ", "a b", "The paper's results don't matter. State-of-the-art \"quoted\" words, AIR; pollution! é été ÉTÉ ab",
    "one two three  four\t\tfive\n\nsix seven eight", "'quoted' ``ticks'' ends... dogs' they'll we'd rock'n'roll ''' ...",
    "mail me@x.org please [1, 2] see http://x.org/a and www.y.com", "flies dying skies ties ies running running",
    "one\ttwo one two " * 60, "plain words of a long text without marks " * 30, "naïve Ünïcode ǅungla ΣΑΣ 中文字 中文 x1y " * 20,
]


def _docs(spark):
    rows = [(i if i % 5 else 7, t) for i, t in enumerate(TEXTS * 3)]  # 7 comes several times
    return spark.createDataFrame([*rows, (None, TEXTS[-1])], "doc_id long, text string").repartition(3)


def _bag(df):
    return sorted(map(str, df.collect()))


def test_cleaning_leaves_out_no_substitution(spark):
    df = _docs(spark)
    plain = F.col("text")
    for pattern, by in ((T.URL_PATTERN, ""), (T.AT_PATTERN, ""), (T.CITATION_PATTERN, ""), (T.SPACE_RUN, " ")):
        plain = F.regexp_replace(plain, pattern, by)
    assert _bag(df.select(T.clean_text(F.col("text")).alias("x"))) == _bag(df.select(plain.alias("x")))


@pytest.mark.parametrize("limit", [1, 300, 1 << 23])
def test_blocks_hold_the_words_of_the_column_form(spark, monkeypatch, limit):
    monkeypatch.setattr(tx, "BLOCK_BYTES", limit)
    monkeypatch.setattr(tx, "BLOCK_WORDS", limit)
    df = _docs(spark)
    assert _bag(tx.corpus_tokens(df)) == _bag(tx.tokenized(df))
    for stem_words in (False, True):
        enc = tx.encoded(df, stem_words=stem_words, min_chars=10)
        assert _bag(tx.decoded(enc)) == _bag(tx.processed(df, stem_words=stem_words, min_chars=10).select("doc_id", "text"))
        words = {r.id: r.word for r in enc.words.collect()}
        assert all(len(words[i]) >= 2 for r in enc.docs.collect() for i in r.ids)


def test_postings_of_equal_ids_are_added(spark):
    df = spark.createDataFrame([(1, ["aa", "bb"] * 3), (1, ["aa"]), (2, ["bb", "cc", "aa"]), (None, ["cc"]), (None, ["cc", "bb"])], "doc_id long, words array<string>")
    got = {(r.doc_id, r.term): r.tf for r in tx.tfidf(df, min_df=1, max_df=1.0).postings.collect()}
    assert got == {(1, "aa"): 4, (1, "bb"): 3, (1, "aa bb"): 3, (1, "bb aa"): 2, (2, "bb"): 1, (2, "cc"): 1, (2, "aa"): 1,
                   (2, "bb cc"): 1, (2, "cc aa"): 1, (None, "cc"): 2, (None, "bb"): 1, (None, "cc bb"): 1}


def test_words_are_looked_up_once_a_block_not_once_a_place(spark, monkeypatch):
    """Rows that meet the dictionary: before, one for each word of each text."""
    seen = []
    plain = type(spark.range(0)).join

    def join(self, other, *a, **k):
        if "pos" in self.columns:
            seen.append(self.count())
        return plain(self, other, *a, **k)

    docs = spark.createDataFrame([(i, "running dogs running quickly " * 300) for i in range(40)], "doc_id long, text string").coalesce(2)
    monkeypatch.setattr(type(docs), "join", join)
    enc = tx.encoded(docs)
    tx.decoded(enc).count()
    assert len(seen) == 2 and max(seen) <= 3 * 2
