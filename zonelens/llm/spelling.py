"""Spelling variants: words one edit apart, found level by level in a trie held as a table.

The trie is path-compressed: its nodes are the prefixes at which words part or end, and an edge
carries the letters between two of them.  A state (word, position, node, edits) starts at the
top for every word.  A level joins the states with the edges of their nodes: a state without an
edit follows its own word's edge, and at a node also parts from it, by another edge's first
letter (replaced) or by leaving out its own next letter (deleted); a state with an edit follows
the one edge that spells the rest of its edited word.  Words part at nodes only, so no edit is
missed between them.  A state with one edit that ends at a word's end has found a neighbour.  Insertions
are the other word's deletions, and of two replaced letters the smaller one's word finds the
larger one.

Near the top nearly every changed letter leads on, so edits are made in the lower half only: a
second trie holds the words spelt backwards, whose lower half is the first half.  Both start
``min_length // 2`` letters down, above which no edit is made.

Scale: texts become counted words in one aggregate; all else works on the words.  Nodes are
named by 64-bit hashes of their prefixes; where two prefixes share a name the states only follow
more edges, since an end is a neighbour only if its text is a word (an exact join).  An edge
says which lengths and next letters go on below it, so that most changed states end at once.
Levels are written tables; a level reads its own nodes only.  There are as many levels as
words part on the longest path, not as many as letters."""
from __future__ import annotations


import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonelens.session import staging_path

from .common import lower_ascii, ship, stored

#: Prefixes that a task holds at a time.
BATCH = 100_000
# The letters of a run (after A-Z have been lower-cased), and the hash divisor of runs that lose a letter
RUN = "[a-zÀ-ÿ]"
MISSPELT = 31
#: A form is at least so many times as frequent.
DOMINANCE = 10


def runs(docs: DataFrame, id_col: str, text_col: str, min_length: int, misspelt: int | None) -> DataFrame:
    """(word) of every run with at least ``min_length`` letters, after the letter that every ``misspelt``-th
    run of a document loses (None: no run does)."""
    found = F.regexp_extract_all(lower_ascii(F.coalesce(F.col(text_col), F.lit(""))), F.lit(f"({RUN}{{{min_length},}})"))
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(found).alias("run"))
    if misspelt is None:
        return rows.select(F.col("run").alias("word"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (h % F.length("run")).cast("int")
    lost = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    word = rows.select(F.when(h % misspelt == 0, lost).otherwise(F.col("run")).alias("word"))
    return word.filter(F.length("word") >= min_length)


def counted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, min_length: int = 7, min_count: int = 2,
            misspelt: int | None = MISSPELT) -> DataFrame:
    """(word, n) of the words that occur ``min_count`` times or more."""
    return runs(docs, id_col, text_col, min_length, misspelt).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count)


def prefixes(words: DataFrame, top: int) -> DataFrame:
    """(key, back, pos, node, letter): every prefix of at least ``top`` letters of the words, forwards and
    backwards; letter is the next one's code point, -1 at the word's end."""

    def run(batches):
        for b in batches:
            out = [], [], [], [], []
            for key, word in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for back, text in enumerate((word, word[::-1])):
                    h = xxhash.xxh64(text[:top].encode(), seed=back)
                    for pos in range(top, len(text) + 1):
                        for col, x in zip(out, (key, bool(back), pos, h.intdigest() - (1 << 63), ord(text[pos]) if pos < len(text) else -1)):
                            col.append(x)
                        h.update(text[pos:pos + 1].encode())
                    if len(out[0]) >= BATCH:
                        yield batch(out)
                        out = [], [], [], [], []
            yield batch(out)

    def batch(out):
        kinds = pa.int64(), pa.bool_(), pa.int32(), pa.int64(), pa.int32()
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(out, kinds)], names=["key", "back", "pos", "node", "letter"])

    return words.select("key", "word").mapInArrow(run, "key long, back boolean, pos int, node long, letter int")


def _bit(letter: str) -> str:
    return f"shiftleft(1L, pmod(hash({letter}), 63))"


def _length_bit(rest: str) -> str:
    return f"shiftleft(1L, least({rest}, 62))"


def trie(words: DataFrame, top: int) -> tuple[DataFrame, str]:
    """((key, back, word, node): where each word starts; path of the edges (depth, node, label, kid, lengths,
    letters), a folder a depth).

    An edge without label and kid stands for a word that ends at the node.  Lengths and letters are bit sets of what
    is left of the words below the edge: how many letters, and the next one."""
    spark = words.sparkSession
    every = stored(prefixes(words, top), "spelling-prefixes")
    parted = every.groupBy("node").agg(F.min("letter").alias("a"), F.max("letter").alias("b"), F.min("pos").alias("pos"))
    parted = stored(parted.filter((F.col("a") != F.col("b")) | (F.col("a") == -1) | (F.col("pos") == top)).select("node"), "spelling-nodes")
    held = every.join(parted, "node").select("key", "back", "pos", "node")
    path = held.groupBy("key", "back").agg(F.sort_array(F.collect_list(F.struct("pos", "node"))).alias("path"))
    path = stored(path.join(words.select("key", "word"), "key"), "spelling-paths")
    start = path.select("key", "back", "word", F.col("path")[0]["node"].alias("node"))

    step = path.select(F.expr("if(back, reverse(word), word)").alias("text"), "path", F.posexplode("path").alias("depth", "at"))
    step = step.withColumn("to", F.get("path", F.col("depth") + 1)).withColumn("rest", F.expr("length(text) - coalesce(to.pos, at.pos)"))
    step = step.select("depth", F.col("at.node").alias("node"), F.col("to.node").alias("kid"),
                       F.expr("if(to is null, '', substring(text, at.pos + 1, to.pos - at.pos))").alias("label"),
                       F.expr(_length_bit("rest")).alias("lengths"),
                       F.expr(f"if(rest = 0, 0L, {_bit('substring(text, coalesce(to.pos, at.pos) + 1, 1)')})").alias("letters"))
    edges = step.groupBy("depth", "node", "kid", "label").agg(F.bit_or("lengths").alias("lengths"), F.bit_or("letters").alias("letters"))
    at = staging_path(spark, "spelling-trie")
    edges.write.partitionBy("depth").parquet(at)
    return start, at


def level(states: DataFrame, edges: DataFrame) -> DataFrame:
    """The states after one more edge: (key, back, least, text, pos, node, edits), and those that have found a
    neighbour, with ``node`` null.  ``text`` is the edited word once ``edits`` is 1; ``least`` is the first
    position at which the word may be edited.

    An alphabet bounds the edges of a node.  A state without an edit takes each of them in up to two ways: by its
    own or a larger first letter, and by the letter after its own, which is left out (``out``)."""
    s = states.withColumns({"here": F.expr("substring(text, pos + 1, 1)"), "after": F.expr("if(edits = 0 and pos >= least, substring(text, pos + 2, 1), null)")})
    e = edges.select("node", "label", "kid", "lengths", "letters", F.expr("substring(label, 1, 1)").alias("first"), F.length("label").alias("size"))
    kept = F.expr("(size > 0 and first = here) or (after is not null and (first > here or (first = after and after <> here)))")
    met = s.join(e, (s["node"] == e["node"]) & kept).drop(s["node"]).drop(e["node"])
    way = met.select("*", F.explode(F.array(F.lit(0), F.lit(1))).alias("out"))
    way = way.filter(F.expr("""if(out = 1, after is not null and first = after and after <> here,
        size > 0 and (first = here or (after is not null and first > here)))"""))
    way = way.withColumn("rest", F.expr("length(text) - pos - size - out"))
    spelt = F.expr("if(first = here or out = 1, substring(text, pos + 1 + out, size) = label, substring(text, pos + 2, size - 1) = substring(label, 2))")
    goes = F.expr(f"""rest >= 0 and ({_length_bit('rest')} & lengths) <> 0 and if(rest = 0, edits = 1 or out = 1 or first <> here,
        ({_bit('substring(text, pos + 1 + out + size, 1)')} & letters) <> 0)""")
    text = """if(out = 1, concat(substring(text, 1, pos), substring(text, pos + 2)),
        if(first = here, text, concat(substring(text, 1, pos), first, substring(text, pos + 2))))"""
    return way.filter(spelt & goes).select("key", "back", "least", F.expr(text).alias("text"), F.expr("pos + size").alias("pos"),
                                           F.expr("if(rest = 0, null, kid)").alias("node"),
                                           F.expr("if(out = 1 or first <> here, 1, edits)").alias("edits"))


def neighbours(words: DataFrame, min_length: int) -> DataFrame:
    """(a, b, n_a, n_b): every two words (key, word, n) that are one edit apart, both ways round."""
    spark = words.sparkSession
    top = min_length // 2
    start, at = trie(words, top)
    half = F.floor(F.length("word") / 2)
    states = start.select("key", "back", F.expr("if(back, reverse(word), word)").alias("text"), F.lit(top).alias("pos"), "node",
                          F.lit(0).alias("edits"), F.when(F.col("back"), F.length("word") - half).otherwise(half).cast("int").alias("least"))
    edges = spark.read.schema("node long, kid long, label string, lengths long, letters long, depth int").parquet(at)
    ends, depth = [], 0
    while not states.isEmpty():
        both = stored(level(states, edges.filter(F.col("depth") == depth)), "spelling-level")
        ends.append(both.filter("node is null").select("key", F.expr("if(back, reverse(text), text)").alias("text")))
        states, depth = both.filter("node is not null"), depth + 1
    if not ends:
        return words.select(*(F.col(c).alias(x) for c, x in (("word", "a"), ("word", "b"), ("n", "n_a"), ("n", "n_b")))).limit(0)
    found = ends[0]
    for more in ends[1:]:
        found = found.unionByName(more)
    b = words.select(F.col("word").alias("b"), F.col("n").alias("n_b"))
    pairs = found.distinct().join(b, F.col("text") == F.col("b")).join(words.select("key", F.col("word").alias("a"), F.col("n").alias("n_a")), "key")
    pairs = stored(pairs.select("a", "b", "n_a", "n_b"), "spelling-pairs")
    return pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), F.col("n_b").alias("n_a"), F.col("n_a").alias("n_b")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): forms followed to the last, twice as far in every round."""
    hops = stored(forms.select("word", F.col("form").alias("root")), "spelling-hops")
    while True:
        on = hops.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = stored(hops.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                            F.col("further").isNotNull().alias("moved")), "spelling-hops")
        hops = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return hops


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, min_length: int = 7, min_count: int = 2,
             dominance: int = DOMINANCE, misspelt: int | None = MISSPELT) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of at least ``min_length`` (1 or more) letters
    with ``min_count`` occurrences.

    Null and empty texts have no words; a null id counts as empty text where runs lose a letter; repeated rows count as often
    as they stand there; of near words with equal n the smallest in code-point order is the form; an empty
    table gives an empty result; other columns are not read.  Words of any length are taken."""
    words = stored(counted(docs, id_col, text_col, min_length=min_length, min_count=min_count, misspelt=misspelt)
                   .withColumn("key", F.monotonically_increasing_id()), "spelling-words")
    near = neighbours(words, min_length)
    best = near.groupBy("a").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n_b")).alias("m"), "b")).alias("top"))
    rows = words.join(best, words["word"] == best["a"], "left")
    strong = -F.col("top.m") >= dominance * F.col("n")
    rows = stored(rows.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                              F.when(strong, F.col("top.b")).alias("form"), F.when(strong, -F.col("top.m")).alias("form_n")), "spelling-forms")
    last = roots(rows.filter("form is not null")).withColumnRenamed("word", "w")
    return (rows.join(last, rows["word"] == last["w"], "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


ship(__name__)
