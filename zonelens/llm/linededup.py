"""Cross-site boilerplate lines by distinct-site spread.

A line's spread is the number of distinct sites that carry it.  Sites are gathered into one
HyperLogLog sketch per line hash; sketches merge by aggregation, so a line on every page
costs one small sketch a task.  Estimates clear of the threshold decide at once; lines whose
estimate lies within the sketch's error band get an exact distinct count.  Lines of at least
``min_sites`` sites are taken out of every text.

Exact copies of a text carry one site between them: a document that was merely
copied to many sites is a duplicate, not boilerplate.  Which of its sites speaks for a text is drawn by a hash of
text and site, so that a site that mirrors many texts does not speak for all of them.

Scale: what is shuffled is 64-bit hashes and sketches, and each text once, to meet its own
short list of lines.  A line held by a third of all rows is pre-aggregated in each task.  All
column expressions, no Python."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, packed, row_key, small, stored

MIN_SITES = 10
MIN_WORDS = 1
LG_K = 8
#: Relative half-width of the band in which an exact count decides: four times the
#: sketch's standard error of 1.04 / sqrt(2 ** LG_K).
BAND = 0.26


def _key(line: Column) -> Column:
    return F.xxhash64(F.trim(F.regexp_replace(line, r"[\x09-\x0D]", " ")))


def _judged(line: Column, min_words: int) -> Column:
    return F.regexp_count(line, F.lit(r"[^\x20\x09-\x0D]+")) >= min_words


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_sites(docs: DataFrame, text_col: str = "text", site_col: str = "source", min_words: int = MIN_WORDS) -> DataFrame:
    """(line, site) pairs: the distinct judged lines of each distinct text, with the one site that
    speaks for all its copies; a null site is a site of its own."""
    lines = F.array_distinct(F.transform(F.filter(_lines(F.col(text_col)), lambda x: _judged(x, min_words)), _key))
    site = F.coalesce(F.col(site_col).cast("string"), F.lit("\0"))
    name = F.md5(F.coalesce(F.col(text_col), F.lit("")))
    rows = docs.select(F.xxhash64(F.col(text_col)).alias("h"), name.alias("name"), lines.alias("lines"), site.alias("site")).filter(F.size("lines") > 0)
    # copies are combined in each task before they are shuffled
    drawn = F.struct(F.md5(F.concat(F.col("name"), F.lit("|"), F.col("site"))).alias("order"), "site")
    one = rows.groupBy("h").agg(F.min(drawn).alias("drawn"), F.first("lines").alias("lines"))
    return one.select(F.explode("lines").alias("line"), F.xxhash64("drawn.site").alias("site"))


def boilerplate(pairs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """(line, sites) of the lines on at least ``min_sites`` distinct sites; sites is exact for the
    lines near the threshold and an estimate beyond."""
    spread = pairs.groupBy("line").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", LG_K)).alias("sites"))
    wide = checkpointed(spread.filter(F.col("sites") >= int(min_sites * (1 - BAND))))
    sure = wide.filter(F.col("sites") > min_sites * (1 + BAND) + 1)
    near = wide.filter(F.col("sites") <= min_sites * (1 + BAND) + 1).select("line")
    exact = pairs.join(small(near), "line", "left_semi").groupBy("line").agg(F.countDistinct("site").alias("sites"))
    return sure.unionByName(exact.filter(F.col("sites") >= min_sites))


def strip_boilerplate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", *,
                      min_sites: int = MIN_SITES, min_words: int = MIN_WORDS, counts: bool = True) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text_col``, and the new columns ``n_lines`` and
    ``n_removed`` (without ``counts``: none, columns of these names stay too).

    Lines end at \\n and are compared without white space around them; lines under
    ``min_words`` words (by default those without a word) are not judged and stay.  A text without boilerplate comes back byte for
    byte, null texts stay null, a text of boilerplate alone becomes empty; repeated rows are
    treated alike; an empty table gives an empty result; columns named as the new ones (in any letter
    case) are replaced, others keep name and value."""
    # the pairs are read twice, so they are made once
    pairs = stored(line_sites(docs, text_col, site_col, min_words), "lines")
    bad = small(checkpointed(boilerplate(pairs, min_sites).select("line")))
    text, new = F.col("text"), ("n_lines", "n_removed") if counts else ()
    rows = docs.select(packed(docs, (*new, text_col)).alias("row"), row_key(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    lines = F.transform(F.filter(_lines(text), lambda x: _judged(x, min_words)), _key)
    held = rows.select(F.col("key").alias("doc"), F.explode(F.array_distinct(lines)).alias("line"))
    per = held.join(bad, "line", "left_semi").groupBy("doc").agg(F.collect_set("line").alias("bad"))
    marked = rows.join(per, F.col("key") == F.col("doc"), "left")
    kept = F.filter(_lines(text), lambda x: ~(_judged(x, min_words) & F.array_contains(F.col("bad"), _key(x))))
    out = marked.select("row", "text", F.when(F.col("bad").isNotNull(), kept).alias("kept"))
    total = F.size(_lines(text))
    cells = {c: F.col("row").getField(c) for c in out.schema["row"].dataType.names}
    cells[text_col] = F.when(F.col("kept").isNull(), text).otherwise(F.array_join("kept", "\n"))
    n = [F.when(text.isNull(), 0).otherwise(total), F.when(F.col("kept").isNull(), 0).otherwise(total - F.size("kept"))]
    return out.select(*[cells[c].alias(c) for c in docs.columns if c.lower() not in new],
                      *[c.cast("long").alias(name) for c, name in zip(n, new)])
