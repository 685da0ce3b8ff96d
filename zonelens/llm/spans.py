"""Substring dedup by sliding sentence spans.

A text is cut into sentences (after . ! ? and at line ends).  Sentences of over ``max_unit``
words are cut further before the words whose hash is the smallest of any ``max_unit``
consecutive words of the sentence: pieces have at most that many words, and where they are cut
depends on the words nearby only, not on the sentence's start.  So a passage of ``min_words`` +
2 ``max_unit`` words holds a whole run wherever it begins, punctuated or not.  In scripts
written without blanks every character counts as a word.  From every sentence or piece a span
of several consecutive ones starts: the shortest run of at least two with at least
``min_words`` words.  Every span is hashed, all hashes meet in one global aggregate that gives
each repeated span its first place (smallest id, then place), and every sentence that lies in
a non-first place of a repeated span is removed.  With ``extend`` the words beside a removed
stretch go too, as far as they are those beside its first place.

Scale: one (hash, row, place) row a sentence is shuffled, not the texts; a hash found in a
third of all rows is pre-aggregated to its minimum in each task, and the join back to the
places is left to adaptive skew splitting.  Each text is shuffled once, to meet its own
places, and to extend once more if it holds first places; what is sent from a first place to
its repeats is the hashes of a bounded number of words.  Sentences are cut by one generator, so
a very long text needs memory for itself only."""
from __future__ import annotations

import re
import zlib
from bisect import bisect_right
from itertools import pairwise

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import packed, row_key, ship, small, stored

MIN_WORDS = 20
MAX_UNIT = 15
#: First places whose words are sent to all tasks (counted); more are joined by a shuffle.
SENT_ROWS = 20_000
#: Texts that a task returns at a time.
OUT_ROWS = 1000
BLANKS = " \t\n\v\f\r"
# Scripts written without blanks: Thai to Tibetan, Burmese, Khmer, kana, Han
UNSPACED = "฀-࿿က-႟ក-៿぀-ヿ㐀-䶿一-鿿豈-﫿\U00020000-\U000323AF"
SENTENCE = re.compile(r"[^\n]*?[.!?。！？｡](?:(?=\s)|(?<=[。！？｡]))|[^\n]+")
BLANKLESS = re.compile(f"[{UNSPACED}]")
PLAIN = re.compile(r"[^\x20\x09-\x0D]+")
WORD = re.compile(rf"[{UNSPACED}]|[^\x20\x09-\x0D{UNSPACED}]+")


def breaks(words: list[bytes], window: int) -> list[int]:
    """The places in a sentence's words before which it is cut: the smallest hash (the last of
    equal ones) of every ``window`` consecutive words; none in a sentence of no more words."""
    if len(words) <= window:
        return []
    h = list(map(zlib.crc32, words))

    def lowest(a, b):
        part = h[a:b][::-1]
        return b - 1 - part.index(min(part))

    at = lowest(0, window)
    out = [at] if at else []
    for i in range(window, len(h)):
        if h[i] <= h[at]:
            at = i
        elif at <= i - window:
            at = lowest(i - window + 1, i + 1)
        else:
            continue
        out.append(at)
    return out


def has_blanks(text: str) -> bool:
    return text.isascii() or BLANKLESS.search(text) is None


def cuts(text: str | None, max_unit: int):
    """(sentence, lower-cased words, places of its pieces in them) of the sentences with a word."""
    blanks = has_blanks(text or "")
    for m in SENTENCE.finditer(text or ""):
        low = m.group().lower()
        # bytes are split at the white space of PLAIN
        words = low.encode().split() if blanks else [w.encode() for w in WORD.findall(low)]
        if words:
            yield m, words, [0, *breaks(words, max_unit), len(words)]


def sentences(text: str | None, max_unit: int = MAX_UNIT) -> list[tuple[int, int, int]]:
    """(start, stop, words) of the sentences or pieces of a text in order, as character offsets;
    those without a word are left out."""
    out = []
    word = PLAIN if has_blanks(text or "") else WORD
    for m, words, at in cuts(text, max_unit):
        if len(at) == 2:
            whole = m.group()
            out.append((m.end() - len(whole.lstrip(BLANKS)), m.start() + len(whole.rstrip(BLANKS)), len(words)))
        else:
            where = [w.span() for w in word.finditer(text, m.start(), m.end())]
            out += [(where[a][0], where[b - 1][1], b - a) for a, b in pairwise(at)]
    return out


def beside_words(text: str, parts: list[tuple[int, int, int]], unit: int, after: bool, limit: int) -> list[tuple[int, int]]:
    """Up to ``limit`` words from piece ``unit`` on, or before it (the nearest first), as character offsets."""
    word, out = PLAIN if has_blanks(text) else WORD, []
    for k in range(unit, len(parts)) if after else range(min(unit, len(parts)) - 1, -1, -1):
        own = [w.span() for w in word.finditer(text, *parts[k][:2])]
        out += own if after else own[::-1]
        if len(out) >= limit:
            break
    return out[:limit]


def spans(text: str | None, min_words: int = MIN_WORDS, max_unit: int = MAX_UNIT) -> tuple[int, list[tuple[int, int, int]]]:
    """How many sentences and pieces a text has, and (hash, first sentence, sentences) of each of its spans.  Case and white
    space do not count; a run that the text's end cuts short of ``min_words`` is no span."""
    size, form = [], []
    for _, words, at in cuts(text, max_unit):
        size += [b - a for a, b in pairwise(at)]
        form += [" ".join(b" ".join(words[a:b]).decode().split()) for a, b in pairwise(at)]
    out, stop, n = [], 0, 0
    for i in range(len(size)):
        while stop < len(size) and (n < min_words or stop - i < 2):
            n += size[stop]
            stop += 1
        if n < min_words or stop - i < 2:
            break
        out.append((xxhash.xxh64_intdigest("\n".join(form[i:stop])) - (1 << 63), i, stop - i))
        n -= size[i]
    return len(size), out


def places(docs: DataFrame, id_col: str, text_col: str, min_words: int, max_unit: int) -> DataFrame:
    """(h, id, key, at, n): the spans of every row, and a row without h for each with ``n`` sentences and pieces."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            ids, keys, hs, at, ns, id_type = [], [], [], [], [], b.schema.field(0).type
            for i, key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                count, found = spans(text.as_py(), min_words, max_unit)
                found.append((None, -1, count))
                ids += [i] * len(found)
                keys += [key] * len(found)
                for col, values in zip((hs, at, ns), zip(*found)):
                    col += values
                if len(hs) >= 100_000:
                    yield batch(ids, id_type, keys, hs, at, ns)
                    ids, keys, hs, at, ns = [], [], [], [], []
            yield batch(ids, id_type, keys, hs, at, ns)

    def batch(ids, id_type, keys, hs, at, ns):
        return pa.RecordBatch.from_arrays([pa.array(hs, pa.int64()), pa.array(ids, id_type), pa.array(keys, pa.int64()),
                                           pa.array(at, pa.int32()), pa.array(ns, pa.int32())], names=["h", "id", "key", "at", "n"])

    rows = docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"h long, id {kind}, key long, at int, n int")


def repeated(found: DataFrame) -> DataFrame:
    """(key, at, n, first_key, first_at): the places of repeated spans that are not the first of
    their span, and the first."""
    # one aggregate counts the spans and finds their first places: its volume and that of the join follow the number of
    # spans, however many of them repeat.  What is joined is stored: skew splitting needs two plain shuffles
    order = F.struct(F.col("id").isNull().alias("none"), "id", "key", "at")
    first = found.groupBy("h").agg(F.count(F.lit(1)).alias("c"), F.min(order).alias("first")).filter("c > 1")
    first = stored(first.select("h", F.col("first.key").alias("first_key"), F.col("first.at").alias("first_at")), "spans-first")
    places_ = found.select("h", "key", "at", "n")
    return places_.join(first, "h").filter("key <> first_key or at <> first_at").select("key", "at", "n", "first_key", "first_at")


def stretches(hits: DataFrame) -> DataFrame:
    """The hits, each place once (repeated rows have the same), with (a, b): the stretch of sentences that they and those
    that overlap or touch them cover."""
    # one shuffle by document serves the places, the stretches and their ends
    hits = hits.repartition("key").dropDuplicates(["key", "at"])
    by_place = Window.partitionBy("key").orderBy("at")
    end = F.max(F.col("at") + F.col("n")).over(by_place.rowsBetween(Window.unboundedPreceding, -1))
    rows = hits.withColumn("opens", F.when(F.col("at") <= end, 0).otherwise(1))
    rows = rows.withColumn("stretch", F.sum("opens").over(by_place.rowsBetween(Window.unboundedPreceding, 0)))
    own = Window.partitionBy("key", "stretch")
    return rows.withColumns({"a": F.min("at").over(own), "b": F.max(F.col("at") + F.col("n")).over(own)}).drop("opens", "stretch")


def beside(hits: DataFrame, docs: DataFrame, id_col: str, text_col: str, max_unit: int, limit: int) -> DataFrame:
    """(key, sides) with sides (unit, after, words): the hashes of up to ``limit`` words before or after
    the first place of each hit at an end of its stretch."""
    before = hits.filter((F.col("at") == F.col("a")) & (F.col("a") > 0))
    before = before.select("key", F.col("at").alias("unit"), F.lit(False).alias("after"), "first_key", F.col("first_at").alias("first_unit"))
    after = hits.filter(F.col("at") + F.col("n") == F.col("b"))
    after = after.select("key", F.col("b").alias("unit"), F.lit(True).alias("after"), "first_key", (F.col("first_at") + F.col("n")).alias("first_unit"))

    def firsts(batches):
        for b in batches:
            out = {"first_key": [], "first_unit": [], "after": [], "words": []}
            for key, text, asked in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
                text = text.as_py()
                parts = sentences(text, max_unit)
                for r in asked.as_py():
                    near = beside_words(text, parts, r["first_unit"], r["after"], limit)
                    for name, x in zip(out, (key, r["first_unit"], r["after"], word_hashes(text, near))):
                        out[name].append(x)
            yield pa.RecordBatch.from_arrays([pa.array(out[n], t) for n, t in zip(out, (pa.int64(), pa.int32(), pa.bool_(), pa.list_(pa.int64())))], names=list(out))

    asked = stored(before.unionByName(after).distinct(), "spans-borders")
    per = asked.select("first_key", "first_unit", "after").distinct().groupBy("first_key").agg(F.collect_list(F.struct("first_unit", "after")).alias("asked"))
    # what is joined is stored: skew splitting needs two plain shuffles
    per = stored(per, "spans-asked")
    texts = docs.select(row_key(id_col, text_col).alias("first_key"), F.col(text_col).cast("string").alias("text"))
    # few texts hold first places: the others are left where they are
    texts = texts.join(small(per.select("first_key")), "first_key", "left_semi")
    near = texts.join(per, "first_key").mapInArrow(firsts, "first_key long, first_unit int, after boolean, words array<long>")
    place = ["first_key", "first_unit", "after"]
    near = stored(near.filter(F.size("words") > 0).dropDuplicates(place), "spans-beside")
    return asked.join(small(near, SENT_ROWS), place).groupBy("key").agg(F.collect_list(F.struct("unit", "after", "words")).alias("sides"))


def word_hashes(text: str, words: list[tuple[int, int]]) -> list[int]:
    return [xxhash.xxh64_intdigest(text[a:b].lower()) - (1 << 63) for a, b in words]


def extended(text: str, parts: list[tuple[int, int, int]], drop: set[int], sides: list) -> list[tuple[int, int, int]]:
    """(start, stop, words) of the stretches of words (character offsets, ordered, disjoint) beside the dropped sentences that
    equal those beside a first place."""
    more = set()
    for r in sides:
        own = beside_words(text, parts, r["unit"], r["after"], len(r["words"]))
        for where, x, y in zip(own, word_hashes(text, own), r["words"]):
            if x != y:
                break
            more.add(where)
    gone = sorted(parts[k][:2] for k in drop)
    starts = [a for a, _ in gone]
    out = []
    for a, b in sorted(more):
        k = bisect_right(starts, a) - 1
        if k >= 0 and a < gone[k][1]:
            continue
        if out and not text[out[-1][1]:a].strip(BLANKS):
            out[-1] = (out[-1][0], b, out[-1][2] + 1)
        else:
            out.append((a, b, 1))
    return out


def dedup_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, min_words: int = MIN_WORDS,
                max_unit: int = MAX_UNIT, extend: bool = False) -> DataFrame:
    """``docs`` with repeated spans taken out of ``text_col`` and the new columns ``n_sentences``,
    ``n_removed`` (sentences) and ``words_removed``.

    With ``extend`` the words beside a removed stretch go as well while they are those beside its
    first place; they count in ``words_removed`` only.  Null ids come last.  Rows of equal id and text are one
    document: they keep or lose the same sentences.  White space around a removed sentence
    stays; a text without repeats comes back byte for byte; null texts stay null; an empty table
    gives an empty result; columns named as the new ones (in any letter case) are replaced, others keep name and value."""
    found = stored(places(docs, id_col, text_col, min_words, max_unit), "spans")
    hits = stored(stretches(repeated(found.filter("h is not null"))), "spans-hits")
    cut = found.filter("h is null").select("key", F.col("n").alias("count")).dropDuplicates(["key"])
    lost = hits.select("key", "a", "b").distinct().groupBy(F.col("key").alias("k")).agg(F.collect_list(F.struct("a", "b")).alias("lost"))
    cut = cut.join(lost, F.col("key") == F.col("k"), "left").drop("k")
    if extend:
        cut = cut.join(beside(hits, docs, id_col, text_col, max_unit, min_words + 2 * max_unit).withColumnRenamed("key", "k"), F.col("key") == F.col("k"), "left").drop("k")
    else:
        cut = cut.withColumn("sides", F.lit(None).cast("array<struct<unit:int,after:boolean,words:array<bigint>>>"))
    cut = stored(cut, "spans-cut")
    new = ("n_sentences", "n_removed", "words_removed")
    marked = docs.select(packed(docs, (*new, text_col)).alias("row"), row_key(id_col, text_col).alias("doc"), F.col(text_col).cast("string").alias("text"))
    marked = marked.join(cut, marked["doc"] == cut["key"]).select("row", "text", "count", "lost", "sides")
    schema = marked.select("row", "text", *(F.lit(0).cast("long").alias(c) for c in new)).schema

    def run(batches):
        for whole in batches:
            for i in range(0, whole.num_rows, OUT_ROWS):
                b = whole.slice(i, OUT_ROWS)
                texts, gone, words = [], [], []
                for text, lost, sides in zip(b.column(1), b.column(3), b.column(4)):
                    text = text.as_py()
                    if not lost.is_valid:
                        texts.append(text), gone.append(0), words.append(0)
                        continue
                    parts = sentences(text, max_unit)
                    drop = {k for r in lost.as_py() for k in range(r["a"], r["b"])}
                    more = extended(text, parts, drop, sides.as_py() or ())
                    texts.append(without(text, sorted([*(parts[k][:2] for k in drop), *((x, y) for x, y, _ in more)])))
                    gone.append(len(drop)), words.append(sum(parts[k][2] for k in drop) + sum(n for *_, n in more))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string()), b.column(2).cast(pa.int64()),
                                                  pa.array(gone, pa.int64()), pa.array(words, pa.int64())], names=schema.names)

    out = marked.mapInArrow(run, schema)
    own = {c: F.col("row").getField(c) for c in out.schema["row"].dataType.names} | {text_col: F.col("text")}
    kept = [c for c in docs.columns if c.lower() not in new]
    return out.select(*[own[c].alias(c) for c in kept], *[F.col(c) for c in new])


def without(text: str, ranges: list[tuple[int, int]]) -> str:
    """``text`` without the ordered, disjoint character ranges."""
    out, at = [], 0
    for a, b in ranges:
        out.append(text[at:a])
        at = b
    return "".join([*out, text[at:]])


ship(__name__)
