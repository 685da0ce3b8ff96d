"""Corpus preparation and TF-IDF as Spark jobs.

Per document: cleaning, tokenising, stemming and n-grams are column expressions over the
token array (``processed``).  A whole corpus is dictionary-encoded instead (``encode``): its distinct tokens
are stemmed once each and numbered, and documents become arrays of word numbers, so that
a gram of one or two words is one long and words are read back at the end only.  Blocks of documents are split, and their
words looked up, a block's distinct words at a time (Arrow): a text is never shuffled word by word.

Vocabulary: the ``max_features`` grams of largest corpus count (ties by term) among those in enough and
not too many documents.  Most pairs of words occur once or twice; a sketch finds the few that matter: the
counts of all counts of all pairs are summed by hash into ``SKETCH`` buckets, which bound every pair's count from above, and pairs
that hold a word below the least count (a pair is no more frequent than its words) or whose bucket is below the count that ``max_features`` single words reach already, or below ``min_df``, are dropped before
anything is counted exactly.  The result is exact.

TF-IDF: the vocabulary is bounded by a parameter and broadcast to the documents; its postings are shuffled
once, by document, for counts and norm alike.  idf = ln((1 + n) / (1 + df)) + 1
(smoothed), rows are scaled to unit L2 length.
"""
from __future__ import annotations

from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonelens.functions import text as T
from zonelens.functions.stems import stems
from zonelens.session import send_by_value


def corpus(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
           lang: str | None = None, partitions: int | None = None) -> DataFrame:
    """(doc_id, text) of the documents, optionally of one language.

    Text work is CPU-bound per row.  A scan's own splits are kept, so no text is shuffled; a
    caller whose few large files give too few splits names the ``partitions`` to deal them to."""
    df = documents
    if lang is not None:
        df = df.filter(F.col("lang") == F.lit(lang))
    df = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return df if partitions is None else df.repartition(partitions)


def cleaned(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", T.clean_text(F.col("text")).alias("clean_text"))


def tokenized(docs: DataFrame) -> DataFrame:
    """(doc_id, tokens): cleaned, lower-cased, alphabetic 3+ letter non-stopword tokens."""
    return docs.select("doc_id", T.tokens(T.clean_text(F.col("text"))).alias("tokens"))


#: Bytes of text, and words, of a block of documents (one document at least).
BLOCK_BYTES, BLOCK_WORDS = 8 << 20, 1 << 20
send_by_value(__name__)


def _pieces(col: pa.Array, limit: int):
    """(from, to) of stretches of a text or list column of at most ``limit`` bytes or entries, a row at least."""
    size = pc.fill_null(pc.binary_length(col) if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else pc.list_value_length(col), 0)
    at = np.concatenate([[0], np.cumsum(size.to_numpy(zero_copy_only=False).astype(np.int64))])
    a = 0
    while a < len(col):
        b = max(a + 1, int(np.searchsorted(at, at[a] + limit, side="right")) - 1)
        yield a, b
        a = b


def _parted(prepared: pa.Array, rules: dict) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words, number of the word of each place, words of each text) of cleaned, lower-cased texts.  The tests of
    a word (:func:`zonelens.functions.text.tokens`) run once for a distinct part."""
    parts = pc.split_pattern_regex(prepared, rules["separators"])
    found = parts.flatten().dictionary_encode()
    part = found.dictionary
    plain = pc.match_substring_regex(part, rules["word"])
    edge = part
    for pattern in rules["edges"]:
        edge = pc.replace_substring_regex(edge, pattern, "")
    edged = pc.or_(pc.or_(pc.ends_with(part, "."), pc.match_substring(part, "'")), pc.match_substring(part, "`"))
    word = pc.if_else(plain, part, pc.if_else(edged, edge, ""))
    good = pc.and_(pc.match_substring_regex(word, rules["word"]), pc.invert(pc.is_in(word, pa.array(rules["stop"], word.type))))
    named = word.dictionary_encode()
    code = np.where(good.to_numpy(zero_copy_only=False), named.indices.to_numpy(zero_copy_only=False), -1)
    code = code[found.indices.to_numpy(zero_copy_only=False)] if len(part) else np.zeros(0, np.int64)
    width = pc.fill_null(pc.list_value_length(parts), 0).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(prepared)), width)[code >= 0]
    return named.dictionary, code[code >= 0], np.bincount(row, minlength=len(prepared))


def _rules() -> dict:
    return {"separators": T.SEPARATORS, "word": T.WORD, "edges": [T.TRAILING_DOTS, T.CLITIC, T.QUOTES], "stop": T.stopwords()}


def _lists(sizes: np.ndarray, values: pa.Array, null: np.ndarray | None = None) -> pa.Array:
    at = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), values, mask=None if null is None else pa.array(null))


def _prepared(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.lower(T.clean_text(F.col("text"))).alias("text"))


def corpus_tokens(docs: DataFrame) -> DataFrame:
    """:func:`tokenized` of a whole corpus: the same rows, words tested once for a distinct part of a block."""
    rows, rules = _prepared(docs), _rules()
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            for a, z in _pieces(b.column(1), BLOCK_BYTES):
                text = b.column(1).slice(a, z - a)
                words, code, sizes = _parted(text, rules)
                null = text.is_null().to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(a, z - a), _lists(sizes, words.take(pa.array(code)), null)], names=["doc_id", "tokens"])

    return rows.mapInArrow(run, f"doc_id {kind}, tokens array<string>")


#: Buckets of the sketch of pair counts (the ones that pass are broadcast).
SKETCH = 1 << 19
#: Distinct tokens, and characters of them, up to which the dictionary is broadcast (both are counted); beyond, it is joined by a shuffle.
DICTIONARY_ROWS, DICTIONARY_CHARS = 500_000, 16_000_000


def stem_table(tokens: DataFrame, col: str = "tokens") -> DataFrame:
    """(token, stem) for every distinct token of the corpus, each stemmed once."""
    # a small table is stemmed by as many tasks as a large one: its rows cost time, not space
    n = int(tokens.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = tokens.select(F.explode(col).alias("token")).distinct().repartition(n, "token")
    return distinct.select("token", stems(F.array("token"))[0].alias("stem"))


def stemmed(tokens: DataFrame, col: str = "tokens") -> DataFrame:
    """(doc_id, stems): every token replaced by its stem, text order kept."""
    return tokens.select("doc_id", stems(F.col(col)).alias("stems"))


def processed(docs: DataFrame, *, stem_words: bool = True, min_chars: int = 200) -> DataFrame:
    """(doc_id, words, text): the processed document (tokens, stemmed by default, joined
    by blanks), kept when its stripped length exceeds ``min_chars``."""
    tok = tokenized(docs)
    if stem_words:
        words = stemmed(tok).withColumnRenamed("stems", "words")
    else:
        words = tok.withColumnRenamed("tokens", "words")
    text = F.concat_ws(" ", "words")
    return (words.select("doc_id", "words", text.alias("text"))
            .filter(F.length(F.trim(F.col("text"))) > min_chars))


def doc_terms(proc: DataFrame, n_max: int = 2) -> DataFrame:
    """(doc_id, terms): words of 2+ characters (the default token pattern of the
    vectoriser re-reading the processed text), then uni- and bigrams."""
    words = proc.select("doc_id", F.filter("words", lambda w: F.length(w) >= 2).alias("_w"))
    # n-grams refer to the word array several times (also inside a lambda): keep it a
    # column of its own so the tokenising expressions are evaluated once per document
    return words.select("doc_id", T.ngrams(F.col("_w"), n_max).alias("terms"))


def term_frequencies(terms: DataFrame) -> DataFrame:
    return terms.select("doc_id", F.explode("terms").alias("term")).groupBy("doc_id", "term").agg(
        F.count(F.lit(1)).alias("tf"))


@dataclass
class Encoded:
    """A corpus by numbers, written: documents (row, doc_id, ids: its words of 2+ characters in order; all_ids: all its words,
    null where that is the same) and dictionary (id, word)."""
    docs: DataFrame
    words: DataFrame


def numbered(values: DataFrame, col: str, out: str = "id") -> DataFrame:
    """The rows of ``values`` numbered from 0 without gaps, written."""
    from zonelens.operators.zones import checkpointed

    rows = checkpointed(values.withColumn("_m", F.monotonically_increasing_id()))
    part, place = F.shiftright("_m", 33), F.col("_m").bitwiseAND((1 << 33) - 1)
    sizes = {r["p"]: r["c"] for r in rows.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("c")).collect()}  # a line a partition
    before = list(accumulate([0, *(sizes.get(p, 0) for p in range(max(sizes, default=0)))]))
    return rows.select(col, (F.element_at(F.lit(before), part.cast("int") + 1) + place).alias(out))


def encode(tokens: DataFrame, col: str = "tokens", *, stem_words: bool = False, min_chars: int | None = None) -> Encoded:
    """The documents (doc_id, array of tokens) as numbers of their words: the tokens, or their stems.

    ``min_chars``: documents stay if their words, joined by blanks, have more characters.  Rows of equal
    doc_id stay rows of their own."""
    from zonelens.operators.zones import checkpointed

    return _encoded(tokens.select("doc_id", F.col(col).alias("x")), None, stem_words, min_chars)


def _blocks(rows: DataFrame, rules: dict | None, word: str = "string") -> DataFrame:
    """One row a block of documents (doc_id, x), written: row numbers, doc_ids, words of each, the distinct words and the number of
    each place's among them.  ``x`` is a list of words (or their ids), or a text to be parted by ``rules``."""
    from zonelens.operators.zones import checkpointed

    rows = rows.select(F.monotonically_increasing_id().alias("row") if "row" not in rows.columns else F.col("row"), "doc_id", "x")
    kind = rows.schema["doc_id"].dataType.simpleString()
    shape = f"block long, rows array<long>, doc_ids array<{kind}>, sizes array<int>, codes binary, words array<{word}>"

    def run(batches):
        for b in batches:
            for a, z in _pieces(b.column(2), BLOCK_WORDS if rules is None else BLOCK_BYTES):
                row, ids, x = (b.column(j).slice(a, z - a) for j in range(3))
                if rules is None:
                    found = x.flatten().dictionary_encode()
                    code = found.indices.fill_null(-1).to_numpy(zero_copy_only=False)
                    own = np.repeat(np.arange(z - a), pc.fill_null(pc.list_value_length(x), 0).to_numpy(zero_copy_only=False))[code >= 0]
                    words, code, sizes = found.dictionary, code[code >= 0], np.bincount(own, minlength=z - a)
                else:
                    words, code, sizes = _parted(x, rules)
                    # words of the dictionary that are in no document are not sent
                    used, code = np.unique(code, return_inverse=True)
                    words = words.take(pa.array(used))
                one = lambda v: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v)
                yield pa.RecordBatch.from_arrays([row.slice(0, 1), one(row), one(ids), one(pa.array(sizes, pa.int32())),
                                                  pa.array([code.astype("<i4").tobytes()], pa.binary()), one(words)],
                                                 names=["block", "rows", "doc_ids", "sizes", "codes", "words"])

    return checkpointed(rows.mapInArrow(run, shape))


def _looked_up(blocks: DataFrame, table: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """The blocks with ``found``: (pos, fields) of their distinct words in the table."""
    each = blocks.select("block", F.posexplode("words").alias("pos", "t")).join(table, F.col("t") == F.col(key))
    found = each.groupBy(F.col("block").alias("b")).agg(F.collect_list(F.struct("pos", *fields)).alias("found"))
    return blocks.drop("words").join(found, F.col("block") == F.col("b"), "left").drop("block", "b")


def _opened(b: pa.RecordBatch, fields: list[str]):
    """For each block: row numbers, doc_ids, words of each document, and the fields of every place."""
    for k in range(b.num_rows):
        rows, ids, sizes, found = (b.column(j).slice(k, 1).flatten() for j in (0, 1, 2, 4))
        code = np.frombuffer(b.column(3)[k].as_py(), "<i4")
        at = np.argsort(found.field("pos").to_numpy(zero_copy_only=False))[code]
        yield rows, ids, sizes.to_numpy(zero_copy_only=False), [found.field(f).take(pa.array(at)) for f in fields]


def _encoded(rows: DataFrame, rules: dict | None, stem_words: bool, min_chars: int | None) -> Encoded:
    from zonelens.operators.zones import checkpointed

    blocks = _blocks(rows, rules)
    if stem_words:
        table = stem_table(blocks, "words").withColumnRenamed("stem", "word")
    else:
        table = blocks.select(F.explode("words").alias("token")).distinct().withColumn("word", F.col("token"))
    table = checkpointed(table)
    words = numbered(table.select("word").distinct(), "word")
    number = table.join(words.withColumnRenamed("word", "w"), F.col("word") == F.col("w")).select(
        "token", F.col("id").cast("int").alias("id"), F.length("word").alias("size"))
    size = table.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("token")).alias("chars")).first()
    if size["n"] <= DICTIONARY_ROWS and (size["chars"] or 0) <= DICTIONARY_CHARS:
        number = F.broadcast(number)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            for row, ids, n, (word, chars) in _opened(b, ["id", "size"]):
                word, chars = word.to_numpy(zero_copy_only=False), chars.to_numpy(zero_copy_only=False)
                own = np.repeat(np.arange(len(n)), n)
                kept = np.ones(len(n), bool)
                if min_chars is not None:
                    kept = np.bincount(own, chars + 1, minlength=len(n)) - 1 > min_chars
                # as the vectoriser re-reads the processed text: words of 2+ characters make grams
                long = chars >= 2
                short = np.bincount(own[~long], minlength=len(n)) > 0
                lists = []
                for at, null in ((kept[own] & short[own], ~short[kept]), (kept[own] & long, None)):
                    lists.append(_lists(np.bincount(own[at], minlength=len(n))[kept], pa.array(word[at], pa.int32()), null))
                yield pa.RecordBatch.from_arrays([row.filter(pa.array(kept)), ids.filter(pa.array(kept)), *lists], names=["row", "doc_id", "all_ids", "ids"])

    docs = _looked_up(blocks, number, "token", ["id", "size"]).mapInArrow(run, f"row long, doc_id {kind}, all_ids array<int>, ids array<int>")
    return Encoded(checkpointed(docs), words)


def encoded(docs: DataFrame, *, stem_words: bool = True, min_chars: int = 200) -> Encoded:
    """:func:`processed` of a whole corpus, encoded: the same documents and words."""
    return _encoded(_prepared(docs).withColumnRenamed("text", "x"), _rules(), stem_words, min_chars)


def decoded(corpus_: Encoded) -> DataFrame:
    """(doc_id, text): the words of every document read back and joined by blanks."""
    rows = corpus_.docs.select("row", "doc_id", F.coalesce("all_ids", "ids").alias("x"))
    blocks = _blocks(rows, None, "int")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            for _, ids, n, (word,) in _opened(b, ["word"]):
                yield pa.RecordBatch.from_arrays([ids, pc.binary_join(_lists(n, word), " ")], names=["doc_id", "text"])

    return _looked_up(blocks, corpus_.words, "id", ["word"]).mapInArrow(run, f"doc_id {kind}, text string")


@dataclass
class TfidfResult:
    vocabulary: DataFrame  # term, df, total, term_index, idf
    postings: DataFrame    # doc_id, term, term_index, tf, weight
    n_docs: int | None = None


def _singles(ids: Column) -> Column:
    return F.transform(ids, lambda a: F.shiftleft(a.cast("long"), 31))


def _pairs(ids: Column) -> Column:
    n = F.greatest(F.size(ids) - 1, F.lit(0))
    return F.zip_with(F.slice(ids, 1, n), F.slice(ids, 2, n), lambda a, b: F.shiftleft(a.cast("long"), 31) + b + 1)


#: The hash of the sketch, the same in Spark and in numpy: ((g mod first) * second mod third) mod SKETCH.
HASH = (2_147_483_629, 1_299_709, 2_147_483_587)


def _bucket(gram: Column) -> Column:
    a, b, c = HASH
    return F.pmod((gram % a) * b % c, F.lit(SKETCH)).cast("int")


def _pair_buckets(g: np.ndarray) -> np.ndarray:
    a, b, c = HASH
    return g % a * b % c % SKETCH


def _places(ids: pa.Array, heavy: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, pair) of every pair of neighbours, of those only whose words are both ``heavy`` (sorted ids) if such are given."""
    word = ids.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(ids)), ids.value_lengths().to_numpy(zero_copy_only=False))
    both = row[1:] == row[:-1]
    if heavy is not None:
        good = heavy[np.minimum(np.searchsorted(heavy, word), len(heavy) - 1)] == word if len(heavy) else np.zeros(len(word), bool)
        both &= good[1:] & good[:-1]
    return row[1:][both], (word[:-1][both] << 31) + word[1:][both] + 1


def _every_single(ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return (np.repeat(np.arange(len(ids)), ids.value_lengths().to_numpy(zero_copy_only=False)),
            ids.flatten().to_numpy(zero_copy_only=False).astype(np.int64) << 31)


def _runs(row: np.ndarray, g: np.ndarray):
    """(row, gram, count) of the distinct ones, by gram and row; rows come in order."""
    order = np.argsort(g, kind="stable")
    row, g = row[order], g[order]
    at = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (row[1:] != row[:-1])])) if len(g) else np.zeros(0, int)
    return row[at], g[at], np.diff(at, append=len(g))


def _counts(docs: DataFrame, grams) -> DataFrame:
    """(g, df, total) of the grams: ``grams`` gives (row, gram) of every place of a block."""
    def run(batches):
        for b in batches:
            for a, z in _pieces(b.column(0), BLOCK_WORDS):
                _, g, n = _runs(*grams(b.column(0).slice(a, z - a)))
                at = np.flatnonzero(np.diff(g, prepend=-1))
                total = np.add.reduceat(n, at) if len(at) else n
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (g[at], np.diff(at, append=len(g)), total)], names=["g", "df", "total"])

    parts = docs.select("ids").mapInArrow(run, "g long, df long, total long")
    return parts.groupBy("g").agg(F.sum("df").alias("df"), F.sum("total").alias("total"))


def passing_buckets(docs: DataFrame, least: int, heavy: np.ndarray | None = None) -> DataFrame:
    """The buckets of the sketch whose pairs (of ``heavy`` words, if given) may reach the count ``least``: at most ``SKETCH`` rows."""
    def run(batches):
        n = np.zeros(SKETCH, np.int64)
        for b in batches:
            for a, z in _pieces(b.column(0), BLOCK_WORDS):
                n += np.bincount(_pair_buckets(_places(b.column(0).slice(a, z - a), heavy)[1]), minlength=SKETCH)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(n[at], pa.int64())], names=["bucket", "n"])

    parts = docs.select("ids").mapInArrow(run, "bucket int, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n")).filter(F.col("n") >= least).select("bucket")


def _check_grams(n_max: int) -> None:
    if n_max not in (1, 2):
        raise ValueError("grams of one or two words only")


def vocabulary(corpus_: Encoded, *, min_df: int = 3, max_df: float = 0.9, max_features: int = 5000, n_max: int = 2) -> DataFrame:
    """(g, term, df, total, term_index, idf), written: terms in at least ``min_df`` documents and in at most
    ``max_df * n`` of them, the ``max_features`` most frequent in the corpus (ties: term), indexed alphabetically."""
    from zonelens.operators.zones import checkpointed

    _check_grams(n_max)
    docs = corpus_.docs
    n_docs = docs.count()
    fit = (F.col("df") >= min_df) & (F.col("df") <= F.lit(max_df) * n_docs)
    singles = checkpointed(_counts(docs, _every_single).filter(F.col("df") >= min_df))
    kept = singles.filter(fit)
    if n_max == 2:
        top = kept.orderBy(F.col("total").desc()).select("total").limit(max_features).agg(F.count(F.lit(1)).alias("n"), F.min("total").alias("least")).first()
        least = max(min_df, top["least"] if top["n"] == max_features else 0)
        # a pair is in no more documents, and no more often there, than its words
        frequent = singles.filter(F.col("total") >= least).select(F.shiftright("g", 31).alias("id")).orderBy("id")
        heavy = None
        if frequent.count() <= DICTIONARY_ROWS:
            heavy = frequent.toArrow()["id"].to_numpy().astype(np.int64)
        passing = np.zeros(SKETCH, bool)
        passing[passing_buckets(docs, least, heavy).toArrow()["bucket"].to_numpy()] = True
        sent = docs.sparkSession.sparkContext.broadcast((heavy, passing))

        def pairs(ids):
            own, may = sent.value
            row, g = _places(ids, own)
            good = may[_pair_buckets(g)]
            return row[good], g[good]

        kept = kept.unionByName(checkpointed(_counts(docs, pairs).filter(fit & (F.col("total") >= least))))
    first, second = F.shiftright("g", 31), F.col("g").bitwiseAND((1 << 31) - 1) - 1
    a = corpus_.words.select(F.col("id").alias("ia"), F.col("word").alias("wa"))
    b = corpus_.words.select(F.col("id").alias("ib"), F.col("word").alias("wb"))
    named = kept.withColumns({"a": first, "b": second}).join(a, F.col("a") == F.col("ia")).join(b, F.col("b") == F.col("ib"), "left")
    named = named.select("g", "df", "total", F.concat_ws(" ", "wa", "wb").alias("term"))
    # a window without partitioning is fine here: at most max_features rows
    idx = F.row_number().over(Window.orderBy("term")) - 1
    idf = F.log((F.lit(1.0) + n_docs) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    return checkpointed(named.orderBy(F.col("total").desc(), "term").limit(max_features)
                        .select("g", "term", "df", "total", idx.cast("int").alias("term_index"), idf.alias("idf")))


def tfidf(proc: DataFrame | Encoded, *, min_df: int = 3, max_df: float = 0.9, max_features: int = 5000,
          n_max: int = 2) -> TfidfResult:
    """Smoothed TF-IDF postings (long form) of an encoded corpus, or of processed documents (doc_id, words)."""
    corpus_ = proc if isinstance(proc, Encoded) else encode(proc, "words")
    vocab = vocabulary(corpus_, min_df=min_df, max_df=max_df, max_features=max_features, n_max=n_max)
    known = vocab.select("g", "term_index").orderBy("g").toArrow()  # at most max_features rows
    sent = vocab.sparkSession.sparkContext.broadcast((known["g"].to_numpy(), known["term_index"].to_numpy()))
    kind = corpus_.docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        g, index = sent.value
        for b in batches:
            for a, z in _pieces(b.column(1), BLOCK_WORDS):
                ids = b.column(1).slice(a, z - a)
                grams = [_every_single(ids), _places(ids)][:n_max]
                row, found = (np.concatenate(x) for x in zip(*grams))
                at = np.minimum(np.searchsorted(g, found), max(len(g) - 1, 0))
                good = g[at] == found if len(g) else np.zeros(len(found), bool)
                row, at, n = _runs(row[good], at[good])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(a, z - a).take(pa.array(row)), pa.array(index[at], pa.int32()), pa.array(n, pa.int64())],
                                                 names=["doc_id", "term_index", "n"])

    each = corpus_.docs.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, term_index int, n long")
    # one shuffle, by document: counts and norm both keep to it
    tf = each.repartition("doc_id").groupBy("doc_id", "term_index").agg(F.sum("n").alias("tf"))
    tf = tf.join(F.broadcast(vocab.select("term", "term_index", "idf")), "term_index")
    tf = tf.withColumn("w", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("doc_id")))
    return TfidfResult(vocab.drop("g"), tf.select("doc_id", "term", "term_index", "tf", (F.col("w") / norm).alias("weight")))


def tfidf_vectors(postings: DataFrame, docs: DataFrame, vocab: DataFrame, *, out: str = "tfidf") -> DataFrame:
    """(doc_id, tfidf SparseVector): the weights of :func:`tfidf` as ML vectors, for every document of ``docs``.

    Only the idf (bounded by ``max_features``) reaches the driver; counts become vectors in
    Spark ML transformers, JVM-side."""
    idf = [float(r["idf"]) for r in vocab.select("idf").orderBy("term_index").collect()]
    times = F.flatten(F.collect_list(F.array_repeat(F.col("term_index").cast("string"), F.col("tf").cast("int"))))
    terms = postings.groupBy(F.col("doc_id").alias("d")).agg(times.alias("terms"))
    terms = docs.select("doc_id").join(terms, F.col("doc_id") == F.col("d"), "left").select("doc_id", F.coalesce("terms", F.array().cast("array<string>")).alias("terms"))
    cv = CountVectorizerModel.from_vocabulary([str(i) for i in range(len(idf))], inputCol="terms", outputCol="_tf")
    weighted = ElementwiseProduct(scalingVec=Vectors.dense(idf), inputCol="_tf", outputCol="_w")
    norm = Normalizer(p=2.0, inputCol="_w", outputCol=out)
    return norm.transform(weighted.transform(cv.transform(terms))).select("doc_id", out)


def sparse_rows(postings: DataFrame, docs: DataFrame) -> DataFrame:
    """(id, idx, w) of every document: its terms (at most ``max_features``) by index, none for a document without any."""
    entry = F.sort_array(F.collect_list(F.struct("term_index", "weight")))
    rows = postings.groupBy("doc_id").agg(entry.alias("e")).withColumnRenamed("doc_id", "id")
    return (docs.select("doc_id").join(rows, F.col("doc_id") == F.col("id"), "left")
            .select(F.col("doc_id").alias("id"), F.coalesce(F.transform("e", lambda x: x["term_index"]), F.array().cast("array<int>")).alias("idx"),
                    F.coalesce(F.transform("e", lambda x: x["weight"]), F.array().cast("array<double>")).alias("w")))


def join_metadata(docs: DataFrame, meta: DataFrame, *, key: str = "doc_id", on_duplicate: str = "error") -> DataFrame:
    """Inner join of documents and metadata on the key (documents without metadata and
    metadata without a document are dropped).

    Metadata must hold one row per key: ``on_duplicate="error"`` fails the job on a
    repeated key (checked inside the plan, no extra job), ``"first"`` keeps the smallest
    row.  No broadcast hint: metadata grows with the corpus, so adaptive execution
    decides from the measured size."""
    cols = [c for c in meta.columns if c != key]
    agg = meta.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.min(F.struct(*cols)).alias("_m"))
    if on_duplicate == "error":
        agg = agg.withColumn("_m", F.when(F.col("_n") > 1, F.raise_error(
            F.concat(F.lit("duplicate metadata key "), F.col(key).cast("string")))).otherwise(F.col("_m")))
    uniq = agg.select(key, *[F.col("_m")[c].alias(c) for c in cols])
    return docs.join(uniq, key, "inner")


def replace_prefix(col: str, prefix: str):
    """Strip a literal prefix from an id (e.g. a URL base), leaving other ids as they are."""
    c = F.col(col).cast("string")
    return F.when(c.startswith(prefix), F.substring(c, len(prefix) + 1, 1 << 30)).otherwise(c)
