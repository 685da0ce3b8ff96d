"""Registered queries over ``documents`` (and ``labels`` as paper metadata)."""
from __future__ import annotations

from pyspark.sql import functions as F

from zonelens.functions import text as T
from zonelens.operators import text as tx
from zonelens.plans.registry import register, table
from zonelens.plans.sqltext import q, r6


#: Session setting: partitions that the text queries deal the documents to (unset: the scan's splits)
TEXT_PARTITIONS = "spark.zonelens.text.partitions"


def text_partitions(spark) -> int | None:
    n = spark.conf.get(TEXT_PARTITIONS, None)
    return None if n is None else int(n)


def docs(spark, sf):
    return tx.corpus(table(spark, sf, "documents"), partitions=text_partitions(spark))


def enc(spark, sf, stem_words=True):
    return tx.encoded(docs(spark, sf), stem_words=stem_words)


def _g(x: str, pattern: str, repl: str = "") -> str:
    return f"regexp_replace({x}, {q(pattern)}, {q(repl)}, 'g')"


def clean_sql(x: str) -> str:
    c = _g(x, T.URL_PATTERN)
    c = _g(c, T.AT_PATTERN)
    c = _g(c, T.CITATION_PATTERN)
    return _g(c, T.SPACE_RUN, " ")


SW = "[" + ", ".join(q(w) for w in T.stopwords()) + "]"
EDGE = _g(_g(_g("x", T.TRAILING_DOTS), T.CLITIC), T.QUOTES)
TOKENS_SQL = f"""tok AS (SELECT doc_id, list_filter(list_transform(string_split_regex(lower({clean_sql('text')}), {q(T.SEPARATORS)}),
                      lambda x: {EDGE}), lambda x: regexp_matches(x, {q(T.WORD)}) AND NOT list_contains({SW}, x)) AS toks
        FROM documents)"""


@register("text_clean", f"SELECT doc_id, {clean_sql('text')} AS clean_text FROM documents")
def text_clean(spark, sf):
    """URLs, @-tokens, bracketed citations removed, whitespace runs collapsed."""
    return tx.cleaned(docs(spark, sf))


@register("text_tokens", f"WITH {TOKENS_SQL}\nSELECT doc_id, array_to_string(toks, ' ') AS tokens FROM tok")
def text_tokens(spark, sf):
    """G13 + G14 + G16: lower-case tokens, alphabetic, 3+ letters, no stopwords, joined."""
    return tx.tokenized(docs(spark, sf)).select("doc_id", F.concat_ws(" ", "tokens").alias("tokens"))


@register("text_stems")
def text_stems(spark, sf):
    """Stem of every distinct token of the corpus (vocabulary job)."""
    return tx.stem_table(tx.tokenized(docs(spark, sf)))


@register("clean_corpus")
def clean_corpus(spark, sf):
    """B16 + G18: processed (stemmed) documents longer than 200 characters."""
    return tx.decoded(enc(spark, sf))


@register("clean_corpus_unstemmed", f"""WITH {TOKENS_SQL}
SELECT doc_id, array_to_string(toks, ' ') AS text FROM tok WHERE length(trim(array_to_string(toks, ' '))) > 200""")
def clean_corpus_unstemmed(spark, sf):
    """B16 + G18 with the SQL oracle: processed, unstemmed documents longer than 200 characters, encoded and read back."""
    return tx.decoded(enc(spark, sf, stem_words=False))


BIGRAMS = "list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])"
NGRAM_SQL = f"""WITH {TOKENS_SQL},
w AS (SELECT doc_id, list_filter(toks, lambda x: length(x) >= 2) AS w FROM tok),
g AS (SELECT doc_id, unnest(list_concat(w, {BIGRAMS})) AS term FROM w)"""


@register("ngrams", NGRAM_SQL + "\nSELECT doc_id, term, count(*) AS tf FROM g GROUP BY doc_id, term")
def ngrams(spark, sf):
    """Unigram and bigram counts per document (over the unstemmed tokens)."""
    # documents are shuffled as their words; their grams are counted where they are made
    p = tx.corpus_tokens(docs(spark, sf)).withColumnRenamed("tokens", "words").repartition("doc_id")
    return tx.term_frequencies(tx.doc_terms(p))


VOCAB_SQL = f"""WITH {TOKENS_SQL},
proc AS (SELECT doc_id, toks FROM tok WHERE length(trim(array_to_string(toks, ' '))) > 200),
w AS (SELECT doc_id, list_filter(toks, lambda x: length(x) >= 2) AS w FROM proc),
g AS (SELECT doc_id, unnest(list_concat(w, {BIGRAMS})) AS term FROM w),
tf AS (SELECT doc_id, term, count(*) AS tf FROM g GROUP BY doc_id, term),
n AS (SELECT count(*) AS n FROM proc),
st AS (SELECT term, count(*) AS df, sum(tf) AS total FROM tf GROUP BY term),
top AS (SELECT st.* FROM st, n WHERE df >= 3 AND df <= 0.9 * n.n ORDER BY total DESC, term LIMIT 5000),
vocab AS (SELECT term, df, total, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS term_index,
                 ln((1 + n.n) / (1 + df)) + 1 AS idf FROM top, n)"""


@register("vocabulary_unstemmed", VOCAB_SQL + f"\nSELECT term, df, total, term_index, {r6('idf')} AS idf FROM vocab")
def vocabulary_unstemmed(spark, sf):
    """D11 with the SQL oracle: vocabulary (min_df 3, max_df 0.9, top 5000) of the
    unstemmed processed documents (DuckDB has no offline stemmer)."""
    return tx.tfidf(enc(spark, sf, stem_words=False)).vocabulary


@register("tfidf_unstemmed", VOCAB_SQL + f""",
p AS (SELECT tf.doc_id, tf.term, v.term_index, tf.tf, tf.tf * v.idf AS w FROM tf JOIN vocab v USING (term))
SELECT doc_id, term, term_index, tf, {r6('w / sqrt(sum(w * w) OVER (PARTITION BY doc_id))')} AS weight FROM p""")
def tfidf_unstemmed(spark, sf):
    """H19 with the SQL oracle: smoothed, L2-normalised TF-IDF postings of the unstemmed
    processed documents, 1- and 2-grams."""
    return tx.tfidf(enc(spark, sf, stem_words=False)).postings


@register("vocabulary")
def vocabulary(spark, sf):
    """Vocabulary of the stemmed corpus, as in the original analysis."""
    return tx.tfidf(enc(spark, sf)).vocabulary


@register("tfidf")
def tfidf(spark, sf):
    """TF-IDF postings of the stemmed corpus, as in the original analysis."""
    return tx.tfidf(enc(spark, sf)).postings


META_SQL = "SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic FROM documents d JOIN labels l USING (doc_id)"


@register("corpus_join", META_SQL)
def corpus_join(spark, sf):
    """Documents joined to their metadata (inner, one metadata row per key)."""
    return tx.join_metadata(table(spark, sf, "documents"), table(spark, sf, "labels"))


#: Base of the metadata's ids, which are addresses; documents are named by what follows it.
ID_BASE = "https://papers.example/W"


@register("corpus_join_by_address", META_SQL)
def corpus_join_by_address(spark, sf):
    """G11 + C1: metadata whose ids are addresses; their base is stripped before they meet the documents' names."""
    docs = table(spark, sf, "documents").withColumn("doc_id", F.col("doc_id").cast("string"))
    meta = table(spark, sf, "labels").withColumn("doc_id", F.concat(F.lit(ID_BASE), F.col("doc_id").cast("string")))
    meta = meta.withColumn("doc_id", tx.replace_prefix("doc_id", ID_BASE))
    return tx.join_metadata(docs, meta).withColumn("doc_id", F.col("doc_id").cast("long"))
