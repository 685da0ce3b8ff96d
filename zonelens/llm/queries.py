"""One query an operator over its whole table, the pipeline, and the SQL of those that SQL can
express."""
from __future__ import annotations

import corpus_pipeline
from pyspark.sql import functions as F

from zonelens.session import staging_path

from . import centroids, decontam, forest, licenses, linededup, mixing, quality, simhash, spans, spelling, tokencount, toxicity, urls
from .common import read
from .oracles import ORACLES


def op1_simhash(spark, sf_dir):
    rows = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op2_toxicity(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    model = toxicity.train(docs, read(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).withColumnRenamed("id", "doc_id")


def op3_mixing(spark, sf_dir):
    rows, _ = mixing.mix(read(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op4_licenses(spark, sf_dir):
    return licenses.scan(read(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op5_quality(spark, sf_dir):
    led = quality.ledger(read(spark, sf_dir, "documents"))
    base = quality.verdict(F.col("fails"), "base")
    return led.select("doc_id", "m.n_words", "m.word_chars", "m.n_symbols", "m.n_dup_lines", "m.n_repeat_words",
                      (~base).alias("base_failed"), (base & quality.verdict(F.col("fails"), "v2")).alias("kept"), "fails")


def op6_urls(spark, sf_dir):
    return urls.judge(read(spark, sf_dir, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict", "score")


def op7_line_dedup(spark, sf_dir):
    return linededup.strip_boilerplate(read(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_removed", "text")


def op8_token_counts(spark, sf_dir):
    rows = tokencount.token_counts(read(spark, sf_dir, "documents"), staging_path(spark, "tokens"))
    return rows.select(F.col("id").alias("doc_id"), "n_tokens")


def op9_span_dedup(spark, sf_dir):
    rows = spans.dedup_spans(read(spark, sf_dir, "documents").select("doc_id", "text"), extend=True)
    return rows.select("doc_id", "n_sentences", "n_removed", "words_removed", "text")


def op10_decontamination(spark, sf_dir):
    rows = decontam.matches(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return rows.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "distance", "first_word", "end_word")


def op11_spelling(spark, sf_dir):
    return spelling.variants(read(spark, sf_dir, "documents"))


def op12_centroids(spark, sf_dir):
    return centroids.cluster(read(spark, sf_dir, "embeddings"))[0].withColumnRenamed("id", "vec_id")


def op13_forest(spark, sf_dir):
    rows = read(spark, sf_dir, "embeddings")
    return forest.search(rows, rows.filter("vec_id % 50 = 0"))


def queries():
    own = (op1_simhash, op2_toxicity, op3_mixing, op4_licenses, op5_quality, op6_urls, op7_line_dedup, op8_token_counts,
           op9_span_dedup, op10_decontamination, op11_spelling, op12_centroids, op13_forest)
    return {**{f.__name__: f for f in own}, "pipeline": corpus_pipeline.run}


def oracle_sql():
    return {**ORACLES, **({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})}
