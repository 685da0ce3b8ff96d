"""License scans by ordered signature rules.

A text is normalised to its words (A-Z lower-cased, everything but letters, digits and
non-ASCII characters dropped) joined by single blanks.  A rule is a regular expression over
that form with a keyword, a label, a priority and a confidence.  A rule runs only where its
keyword and its anchor occur; overlapping detections are resolved by priority and containment: one that
lies inside another of at least its priority is suppressed (of equal spans and priorities the
earlier rule stays).

Scale: the base digest is narrow, per row.  Only texts that hold a keyword meet the rules, still
inside the row; what is shuffled is the detections (two integers each), by row.  All column
expressions, no Python.  Detections of one text are ordered within that text only."""
from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lower_ascii, row_key, stored

WORD_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# The base phrases and their labels
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: str
    pattern: str  # over the normalised text, whole words
    priority: int
    confidence: float
    anchor: str = " "  # occurs in the normalised text as well, wherever the rule can match


# Families: label, keyword, names as they stand in the normalised text (regular expressions).  Every
# name holds its keyword at the beginning of a word; names without a common keyword have a line each.
# Three rules come from each: a grant naming the license, an identifier line, a mention.
FAMILIES = [
    ("mit", "mit", "mit(?: expat| x11)?"),
    ("mit-0", "mit no attribution", "mit no attribution"),
    ("mit-0", "mit 0", "mit 0"),
    ("isc", "isc", "isc"),
    ("bsd", "bsd", "(?:new |modified |simplified |revised )?bsd(?: style)?"),
    ("bsd", "freebsd", "freebsd(?: style)?"),
    ("bsd-2-clause", "bsd", "(?:2|two) clause bsd|bsd (?:2|two) clause"),
    ("bsd-3-clause", "bsd", "(?:3|three) clause bsd|bsd (?:3|three) clause"),
    ("bsd-4-clause", "bsd", "(?:4|four) clause bsd|bsd (?:4|four) clause"),
    ("0bsd", "0bsd", "0bsd"),
    ("0bsd", "bsd", "zero clause bsd|bsd zero clause"),
    ("zlib", "zlib", "zlib(?: libpng)?"),
    ("boost-1.0", "boost", "boost software(?: version)?"),
    ("boost-1.0", "bsl 1 0", "bsl 1 0"),
    ("unlicense", "unlicense", "unlicense"),
    ("wtfpl", "wtfpl", "wtfpl"),
    ("postgresql", "postgresql", "postgresql"),
    ("python-2.0", "python", "python software foundation"),
    ("python-2.0", "psf", "psf"),
    ("artistic-1.0", "artistic", "artistic(?: version)? 1 0"),
    ("artistic-2.0", "artistic", "artistic(?: version)? 2 0"),
    ("ms-pl", "microsoft", "microsoft public"),
    ("ms-rl", "microsoft", "microsoft reciprocal"),
    ("ofl-1.1", "font", "sil open font|open font"),
    ("odc-by", "open data", "open data commons attribution"),
    ("odbl", "database", "open database"),
    ("pddl", "public domain dedication", "open data commons public domain dedication"),
    ("ncsa", "ncsa", "ncsa(?: university of illinois)?"),
    ("openssl", "openssl", "openssl"),
    ("curl", "curl", "curl"),
    ("vim", "vim", "vim"),
    ("ruby", "ruby", "ruby"),
    ("perl", "perl", "perl"),
    ("php-3.01", "php", "php(?: version)?(?: 3 01)?"),
    ("zpl-2.1", "zope", "zope public"),
    ("w3c", "w3c", "w3c(?: software)?"),
    ("eupl", "european union", "european union public"),
    ("cecill", "cecill", "cecill(?: [abc])?"),
    ("sspl", "server side", "server side public"),
    ("bsl-1.1", "business source", "business source"),
    ("elastic-2.0", "elastic", "elastic(?: version)?(?: 2 0)?"),
    ("commons-clause", "commons clause", "commons clause"),
    ("json", "json", "json"),
    ("ibm-public", "ibm", "ibm public"),
    ("nokia", "nokia", "nokia open source"),
    ("sun-public", "sun", "sun public"),
    ("upl-1.0", "universal permissive", "universal permissive"),
    ("ecl-2.0", "educational", "educational community"),
    ("afl-3.0", "academic free", "academic free"),
    ("osl-3.0", "open software", "open software"),
    # SPDX short names of the families above
    ("ms-pl", "ms pl", "ms pl"),
    ("ms-rl", "ms rl", "ms rl"),
    ("ofl-1.1", "ofl", "ofl 1 1"),
    ("odc-by", "odc by", "odc by"),
    ("odbl", "odbl", "odbl"),
    ("pddl", "pddl", "pddl"),
    ("zpl-2.1", "zpl", "zpl 2 1"),
    ("eupl", "eupl", "eupl"),
    ("sspl", "sspl", "sspl"),
    ("bsl-1.1", "busl", "busl 1 1"),
    ("ibm-public", "ipl", "ipl 1 0"),
    ("upl-1.0", "upl", "upl 1 0"),
    ("ecl-2.0", "ecl", "ecl 2 0"),
    ("afl-3.0", "afl", "afl 3 0"),
    ("osl-3.0", "osl", "osl 3 0"),
]
# Families with versions: label, keyword, name, versions as spoken
VERSIONED = [
    ("apache", "apache", "apache(?: software)?", ("1 0", "1 1", "2 0")),
    ("gpl", "general public", "(?:gnu )?general public", ("1", "2", "3", "2 0", "3 0")),
    ("gpl", "gpl", "gnu gpl|gpl", ("2", "3", "2 0", "3 0")),
    ("lgpl", "lesser general", "(?:gnu )?lesser general public", ("2 1", "3", "3 0")),
    ("lgpl", "library general", "(?:gnu )?library general public", ("2", "2 0")),
    ("agpl", "affero", "(?:gnu )?affero general public", ("1", "3", "3 0")),
    ("gfdl", "free documentation", "(?:gnu )?free documentation", ("1 1", "1 2", "1 3")),
    ("mpl", "mozilla", "mozilla public", ("1 0", "1 1", "2 0")),
    ("epl", "eclipse", "eclipse public", ("1 0", "2 0")),
    ("cddl", "common development", "common development and distribution", ("1 0", "1 1")),
    ("cpl", "common public", "common public", ("1 0",)),
    ("apsl", "apple", "apple public source", ("1 0", "2 0")),
    ("lppl", "latex", "latex project public", ("1 2", "1 3")),
    ("lgpl", "lgpl", "(?:gnu )?lgpl", ("2", "2 1", "3", "2 0", "3 0")),
    ("agpl", "agpl", "(?:gnu )?agpl", ("1", "3", "1 0", "3 0")),
    ("gfdl", "gfdl", "gfdl", ("1 1", "1 2", "1 3")),
    ("gfdl", "gnu fdl", "gnu fdl", ("1 1", "1 2", "1 3")),
    ("mpl", "mpl", "mpl", ("1 0", "1 1", "2 0")),
    ("epl", "epl", "epl", ("1 0", "2 0")),
    ("cddl", "cddl", "cddl", ("1 0", "1 1")),
    ("cpl", "cpl", "cpl", ("1 0",)),
    ("apsl", "apsl", "apsl", ("1 0", "2 0")),
    ("lppl", "lppl", "lppl", ("1 2", "1 3", "1 3c")),
]
# Short names that mean nothing else: a mention needs no "license" behind them
ALONE = ("gpl", "lgpl", "agpl", "gfdl", "gnu fdl", "cddl", "lppl", "apsl")
CC_KINDS = {"by": "attribution", "by-sa": "attribution share ?alike", "by-nd": "attribution no ?deriv(?:ative)?s?",
            "by-nc": "attribution non ?commercial", "by-nc-sa": "attribution non ?commercial share ?alike",
            "by-nc-nd": "attribution non ?commercial no ?deriv(?:ative)?s?"}
CC_VERSIONS = ("2 0", "2 5", "3 0", "4 0")
# Notices that name no license: label, keyword, pattern, priority, confidence
NOTICES = [
    ("mit", "permission is hereby granted", "permission is hereby granted free of charge to any person obtaining a copy", 3, 1.0),
    ("isc", "permission to use", "permission to use copy modify and or distribute this software for any purpose", 3, 1.0),
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted", 3, 1.0),
    ("bsd-3-clause", "endorse", "neither the names? of .{1,80}? may be used to endorse or promote products", 3, 0.9),
    ("zlib", "warranty", "this software is provided as is without any express or implied warranty in no event", 3, 0.9),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain", 3, 1.0),
    ("gpl", "free software foundation", "as published by the free software foundation", 2, 0.8),
    ("apache-2.0", "apache", "apache org licenses license 2 0", 3, 1.0),
    ("public-domain", "public domain", "(?:released|placed|dedicated|is|in)(?: in| into| to)? the public domain", 1, 0.7),
    ("cc0", "cc0", "cc0(?: 1 0)?(?: universal)?", 3, 0.9),
    ("cc0", "creative commons", "creative commons zero", 3, 0.9),
    ("cc", "creative commons", "creative commons", 1, 0.6),
    ("proprietary", "all rights reserved", "all rights reserved", 1, 0.5),
    ("proprietary", "confidential", "proprietary and confidential", 2, 0.8),
    ("copyright", "copyright", "copyright (?:c )?(?:19|20)[0-9]{2}", 1, 0.4),
]


def rules() -> list[Rule]:
    """The rule table: notices as they stand, and the rules that the families stand for."""
    out = [Rule(a, k, p, pr, c) for a, k, p, pr, c in NOTICES]
    lic = "licen[cs]e"
    for label, key, name in FAMILIES:
        out += [Rule(label, key, f"(?:licensed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?(?:{name})(?: {lic})?", 3, 0.95, " under "),
                Rule(label, key, f"(?:spdx )?{lic} identifier (?:{name})", 3, 1.0, " identifier "),
                Rule(label, key, f"(?:{name}) {lic}", 2, 0.8, " licen")]
    for label, key, name, versions in VERSIONED:
        out.append(Rule(label, key, f"(?:{name}) {lic}" if key not in ALONE else name, 2, 0.7))
        for v in versions:
            full = f"{label}-{v.replace(' ', '.') if ' ' in v else v + '.0'}"
            out.append(Rule(full, key, f"(?:{name})(?: {lic})?(?: version| v)? ?v?{v}(?: or (?:any )?later)?", 3, 0.95))
            out.append(Rule(full, key, f"under (?:the )?(?:terms of )?(?:the )?(?:{name})(?: {lic})?(?: version| v)? ?v?{v}(?: or (?:any )?later(?: version)?)?", 4, 1.0))
    for kind, spoken in CC_KINDS.items():
        short = kind.replace("-", " ")
        for v in CC_VERSIONS:
            full = f"cc-{kind}-{v.replace(' ', '.')}"
            out.append(Rule(full, "cc", f"cc {short} {v}", 4, 1.0))
            out.append(Rule(full, "creative commons", f"creative commons {spoken} {v}", 4, 1.0))
            out.append(Rule(full, "creativecommons", f"creativecommons org licenses {short} {v}", 4, 1.0))
        out.append(Rule(f"cc-{kind}", "cc", f"cc {short}", 3, 0.8))
        out.append(Rule(f"cc-{kind}", "creative commons", f"creative commons {spoken}", 3, 0.8))
    return out


def normalised(text: Column) -> Column:
    """Words joined by single blanks, one blank before the first and after the last; a text
    without words gives one blank."""
    t = F.regexp_replace(lower_ascii(F.coalesce(text, F.lit(""))), WORD_BREAK, " ")
    return F.regexp_replace(F.concat(F.lit(" "), t, F.lit(" ")), "^ +| +$", " ")


def _blanks(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))


def _places(phrase: str) -> str:
    return f"(?<= )(?:{phrase})(?= )"


def base_digest(t: Column) -> dict[str, Column]:
    """n_words, n_base, first_word, last_word and the array of base labels; ``t`` is a column of
    normalised text.  Words are counted from 0."""
    some = _places("|".join(BASE))
    first = F.regexp_instr(t, F.lit(some))  # place of the first character, from 1
    tail = F.regexp_extract(t, f"(?s)^(.*){some}", 1)  # the text before the last place
    hit = first > 0
    return {
        "n_words": F.greatest(_blanks(t) - 1, F.lit(0)).cast("long"),
        "n_base": F.regexp_count(t, F.lit(some)).cast("long"),
        "first_word": F.when(hit, _blanks(F.substring(t, F.lit(1), first - 1)) - 1).cast("long"),
        "last_word": F.when(hit, _blanks(tail) - 1).cast("long"),
        "base": F.array_compact(F.array(*[F.when(F.contains(t, F.lit(f" {p} ")), F.lit(label)) for p, label in BASE.items()])),
    }


def hits(t: Column, table: list[Rule]) -> Column:
    """Array of (rule, hit, gap) of the rules that match a normalised text: the lengths of the matches
    and of the pieces between them."""
    lit = F.array(*[F.struct(F.lit(k).cast("int").alias("rule"), F.lit(f" {r.keyword}").alias("keyword"), F.lit(r.anchor).alias("anchor"),
                             F.lit(_places(r.pattern)).alias("re")) for k, r in enumerate(table)])
    lengths = lambda a: F.transform(a, lambda x: F.length(x))
    gated = F.filter(lit, lambda r: F.contains(t, r["keyword"]) & F.contains(t, r["anchor"]))
    runs = F.transform(gated, lambda r: F.struct(r["rule"].alias("rule"), lengths(F.regexp_extract_all(t, r["re"], F.lit(0))).alias("hit"), r["re"].alias("re")))
    found = F.transform(F.filter(runs, lambda r: F.size(r["hit"]) > 0),
                        lambda r: F.struct(r["rule"].alias("rule"), r["hit"].alias("hit"), lengths(F.split(t, r["re"])).alias("gap")))
    # most texts hold no anchor or keyword at all: they are told by a few searches, without the table
    some = sorted({r.anchor if r.anchor != " " else f" {r.keyword}" for r in table})
    gate = reduce(lambda a, b: a | b, [F.contains(t, F.lit(x)) for x in some])
    return F.when(gate, found).otherwise(F.array().cast("array<struct<rule:int,hit:array<int>,gap:array<int>>>"))


def detections(found: DataFrame, table: list[Rule] | None = None) -> DataFrame:
    """(key, rule, label, priority, confidence, start, stop) of every detection that stays, from
    (key, found) rows as :func:`hits` gives them; start and stop are character offsets."""
    table = rules() if table is None else table
    about = F.array(*[F.struct(F.lit(r.label).alias("label"), F.lit(r.priority).alias("priority"), F.lit(r.confidence).alias("confidence")) for r in table])
    # rows of equal id and text have one key: one of them speaks for all.  Both windows below need
    # no other shuffle than this one
    rows = found.dropDuplicates(["key"]).select("key", F.explode("found").alias("r"))
    # the pieces between the hits give the places of the hits
    rows = rows.select("key", "r.rule", F.posexplode(F.arrays_zip(F.col("r.gap").alias("gap"), F.col("r.hit").alias("hit"))).alias("i", "x"))
    rows = rows.select("key", "rule", "i", "x.gap", "x.hit")
    upto = F.sum(F.col("gap") + F.coalesce("hit", F.lit(0))).over(Window.partitionBy("key", "rule").orderBy("i"))
    rows = rows.withColumn("stop", upto).filter("hit is not null").withColumn("start", F.col("stop") - F.col("hit"))
    rows = rows.withColumn("a", F.element_at(about, F.col("rule") + 1)).select("key", "rule", "a.*", "start", "stop")
    # whatever contains a detection comes before it in this order
    before = (Window.partitionBy("key").orderBy("start", F.col("stop").desc(), F.col("priority").desc(), "rule")
              .rowsBetween(Window.unboundedPreceding, -1))
    levels = sorted({r.priority for r in table})
    reach = [F.max(F.when(F.col("priority") >= level, F.col("stop"))).over(before).alias(f"reach{level}") for level in levels]
    rows = rows.select("*", *reach)
    over = F.coalesce(*[F.when(F.col("priority") == level, F.col(f"reach{level}")) for level in levels])
    return rows.filter(over.isNull() | (over < F.col("stop"))).drop(*[f"reach{level}" for level in levels])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every row.

    labels are the base ones and those of the detections that stay, sorted; score is the
    highest confidence among them (0.5 for a base place alone, 0 without any).  Null and empty
    texts have no words and no labels; repeated rows are repeated; an empty table gives an
    empty result; other columns are not read."""
    key = row_key(id_col, text_col)
    rows = docs.select(F.col(id_col).alias("id"), key.alias("key"), normalised(F.col(text_col)).alias("t"))
    digest = base_digest(F.col("t"))
    # the texts are read once; what is kept of them is narrow
    read = stored(rows.select("id", "key", *[c.alias(k) for k, c in digest.items()], hits(F.col("t"), rules()).alias("found")), "licenses")
    narrow = read.drop("found")
    per = detections(read.filter(F.size("found") > 0)).groupBy("key").agg(F.collect_set("label").alias("more"), F.max("confidence").alias("confidence"))
    both = narrow.join(per, "key", "left")
    base, more = F.col("base"), F.coalesce("more", F.array().cast("array<string>"))
    return both.select(
        "id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, more)), ",").alias("labels"),
        F.greatest(F.coalesce("confidence", F.lit(0.0)), F.when(F.col("n_base") > 0, F.lit(0.5)).otherwise(F.lit(0.0))).alias("score"))
