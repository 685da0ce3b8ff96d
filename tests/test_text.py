import pytest
from pyspark.sql import functions as F

from zonelens.functions import text as T
from zonelens.operators import text as tx
from zonelens.plans import q_text

SF = "/root/testdata/sf0.001"


def test_cleaning_patterns(spark):
    s = ("See http://x.org/a and www.y.com now, mail me@x.org please [1, 2] [3]\n\n  end x")
    df = spark.createDataFrame([(1, s)], "doc_id long, text string")
    out = tx.cleaned(df).first()["clean_text"]
    assert out == "See and now, mail please end x"


def test_tokens_rule(spark):
    s = "The paper's results don't matter. State-of-the-art \"quoted\" words, AIR; pollution! é été ab"
    df = spark.createDataFrame([(1, s)], "doc_id long, text string")
    toks = tx.tokenized(df).first()["tokens"]
    # stopwords (the, results, paper), hyphenated and short tokens are removed
    assert toks == ["matter", "quoted", "words", "air", "pollution", "été"]


def test_ngrams(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), ([],), (["x"],)], "w array<string>")
    out = [r[0] for r in df.select(T.ngrams(F.col("w"))).collect()]
    assert out == [["a", "b", "c", "a b", "b c"], [], ["x"]]


# words of the published description of the algorithm, with the result of all its steps
PUBLISHED = dict(pair.split(":") for pair in """
caresses:caress ponies:poni caress:caress cats:cat agreed:agre plastered:plaster bled:bled motoring:motor sing:sing
conflated:conflat troubled:troubl sized:size hopping:hop tanned:tan falling:fall hissing:hiss fizzed:fizz failing:fail
filing:file happy:happi relational:relat conditional:condit rational:ration digitizer:digit radically:radic
differently:differ analogously:analog operator:oper feudalism:feudal decisiveness:decis hopefulness:hope
callousness:callous formality:formal sensitivity:sensit sensibility:sensibl triplicate:triplic formative:form
formalize:formal electrical:electr goodness:good revival:reviv allowance:allow inference:infer airliner:airlin
adjustable:adjust defensible:defens irritant:irrit replacement:replac adjustment:adjust dependent:depend
adoption:adopt communism:commun activate:activ homologous:homolog effective:effect probate:probat rate:rate
cease:ceas controll:control roll:roll
ties:tie tied:tie dying:die skies:sky news:news generalization:gener pollution:pollut syzygy:syzygi été:été
""".split())


def test_stems_of_the_published_words(spark):
    words = list(PUBLISHED)
    df = spark.createDataFrame([(1, words), (2, []), (3, ["by", "s", "ing", "ied"])], "doc_id long, tokens array<string>")
    out = {r.doc_id: r.stems for r in tx.stemmed(df).collect()}
    assert dict(zip(words, out[1])) == PUBLISHED
    assert out[2] == [] and out[3] == ["by", "s", "ing", "i"]


def test_stemming_is_narrow_and_without_python(spark):
    docs = spark.createDataFrame([(1, "running dogs")], "doc_id long, text string")
    plan = tx.processed(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Join" not in plan and "Aggregate" not in plan


def test_tfidf_rows_unit_length_and_idf(spark):
    docs = [(i, " ".join(["alpha beta gamma delta"] * 3 + [f"word{i}"] * 2)) for i in range(5)]
    docs.append((9, "alpha alpha epsilon epsilon epsilon zeta zeta zeta"))
    proc = spark.createDataFrame(docs, "doc_id long, text string").select(
        "doc_id", F.split("text", " ").alias("words"), "text")
    res = tx.tfidf(proc, min_df=2, max_df=0.9, max_features=100)
    vocab = {r.term: r for r in res.vocabulary.collect()}
    assert "alpha" not in vocab  # in all 6 documents: above max_df
    assert "beta" in vocab and "beta gamma" in vocab and "epsilon" not in vocab
    norms = res.postings.groupBy("doc_id").agg(F.sum(F.col("weight") ** 2).alias("n")).collect()
    assert all(r.n == pytest.approx(1.0) for r in norms)
    import math
    assert vocab["beta"].idf == pytest.approx(math.log(7 / 6) + 1)


def test_metadata_join_rejects_duplicates(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    meta = spark.createDataFrame([(1, 5), (1, 6), (2, 7)], "doc_id long, cited long")
    with pytest.raises(Exception):
        tx.join_metadata(docs, meta).collect()
    firsts = {r.doc_id: r.cited for r in tx.join_metadata(docs, meta, on_duplicate="first").collect()}
    assert firsts == {1: 5, 2: 7}
    ids = spark.createDataFrame([("https://base.example/W7",), ("W8",)], "id string")
    assert [r[0] for r in ids.select(tx.replace_prefix("id", "https://base.example/")).collect()] == ["W7", "W8"]


def test_documents_keep_their_splits_unless_told(spark):
    plain = q_text.docs(spark, SF)
    spark.conf.set(q_text.TEXT_PARTITIONS, "3")
    try:
        dealt = q_text.docs(spark, SF)
    finally:
        spark.conf.unset(q_text.TEXT_PARTITIONS)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan(plain) and "RoundRobinPartitioning(3)" in plan(dealt)
    assert sorted(map(str, plain.collect())) == sorted(map(str, dealt.collect()))


def test_encoded_corpus_is_the_processed_one(spark):
    docs = q_text.docs(spark, SF)
    for stem_words in (False, True):
        want = {r.doc_id: r.text for r in tx.processed(docs, stem_words=stem_words).collect()}
        enc = tx.encoded(docs, stem_words=stem_words)
        assert {r.doc_id: r.text for r in tx.decoded(enc).collect()} == want
        ids = [r.id for r in enc.words.collect()]
        assert sorted(ids) == list(range(len(ids)))


def test_each_distinct_token_is_stemmed_once(spark):
    docs = spark.createDataFrame([(i, "running dogs running quickly " * 30) for i in range(40)], "doc_id long, text string")
    table = tx.stem_table(tx.tokenized(docs))
    assert {r.token: r.stem for r in table.collect()} == {"running": "run", "dogs": "dog", "quickly": "quickli"}
    plan = table._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") > plan.index("Project")  # the distinct comes below the stems


def _counted_plainly(rows, n_max, min_df, max_df, max_features):
    from collections import Counter

    total, df = Counter(), Counter()
    for words in rows:
        words = [w for w in words if len(w) >= 2]
        grams = words + [" ".join(p) for p in zip(words, words[1:])] * (n_max == 2)
        total.update(grams), df.update(set(grams))
    kept = [t for t in total if min_df <= df[t] <= max_df * len(rows)]
    top = sorted(kept, key=lambda t: (-total[t], t))[:max_features]
    return {t: (df[t], total[t], k) for k, t in enumerate(sorted(top))}


@pytest.mark.parametrize("max_features, n_max", [(5, 2), (40, 2), (40, 1), (10_000, 2)])
def test_sketched_vocabulary_is_exact(spark, max_features, n_max):
    import random

    rng = random.Random(3)
    words = [f"w{k}" for k in range(60)] + ["x"]
    rows = [[words[min(60, int(rng.expovariate(0.08)))] for _ in range(rng.randrange(0, 80))] for _ in range(50)]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "doc_id long, words array<string>")
    res = tx.tfidf(df, min_df=2, max_df=0.8, max_features=max_features, n_max=n_max)
    got = {r.term: (r.df, r.total, r.term_index) for r in res.vocabulary.collect()}
    assert got == _counted_plainly(rows, n_max, 2, 0.8, max_features)


def test_sketch_drops_most_pairs_before_they_are_counted(spark):
    enc = tx.encoded(q_text.docs(spark, "/root/testdata/sf0.01"), stem_words=False)
    pairs = enc.docs.select(F.explode(tx._pairs(F.col("ids"))).alias("g"))
    every = pairs.distinct().count()
    passing = tx.passing_buckets(enc.docs, 20)
    left = pairs.withColumn("bucket", tx._bucket(F.col("g"))).join(passing, "bucket", "left_semi").select("g").distinct().count()
    heavy = pairs.groupBy("g").count().filter("count >= 20").count()
    assert heavy <= left < every / 4


def test_postings_are_shuffled_once(spark):
    res = tx.tfidf(tx.encoded(q_text.docs(spark, SF)))
    plan = res.postings._jdf.queryExecution().optimizedPlan().toString()
    res.postings.count()
    final = res.postings._jdf.queryExecution().executedPlan().toString()
    assert final.count("Exchange hashpartitioning") == 1 and "Window" in plan
