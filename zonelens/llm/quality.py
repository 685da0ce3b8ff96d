"""Quality rules as a bitmask ledger.

Every rule is evaluated once a document: the ledger stores the measurements and one failure
bit a rule.  A policy is a named, versioned set of rules; its verdict is a bitwise AND of the
ledger with the policy's mask, so policies can be changed, compared and ablated without
reading a text again.

All of it is column expressions, narrow per row: no shuffle, no Python.  Repeated 8-word
windows are found inside the row from the sorted window hashes, in O(n log n) for a text of
n words."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import own, unused, words

WINDOW = 8

#: name -> (failure test over the measurements, what it means); the place is the bit.
RULES = {
    "few_words": (lambda m: m("n_words") < 20, "fewer than 20 words"),
    "repeated_words": (lambda m: 100 * m("n_repeat_words") > 30 * m("n_words"), "over 30 % of the words stand in repeated 8-word windows"),
    "short_words": (lambda m: m("word_chars") < 2 * m("n_words"), "mean word under 2 characters"),
    "long_words": (lambda m: m("word_chars") > 20 * m("n_words"), "mean word over 20 characters"),
    "symbols": (lambda m: 10 * m("n_symbols") > 3 * m("n_words"), "over 3 symbols in 10 words"),
    "duplicate_lines": (lambda m: 100 * m("n_dup_lines") > 50 * m("n_lines"), "over half the lines repeat an earlier one"),
    "few_letters": (lambda m: 100 * m("n_letters") < 60 * m("word_chars"), "under 60 % of the characters in words are letters"),
    "shouting": (lambda m: 100 * m("n_upper_chars") > 60 * m("word_chars"), "over 60 % of the characters are capitals"),
    "ellipsis_lines": (lambda m: 100 * m("n_ellipsis_lines") > 50 * m("n_lines"), "over half the lines end in an ellipsis"),
    "bullet_lines": (lambda m: 100 * m("n_bullet_lines") > 95 * m("n_lines"), "over 95 % of the lines are bullets"),
}
BITS = {name: 1 << k for k, name in enumerate(RULES)}

#: version -> rules whose failure rejects a document
POLICIES = {
    "base": ("few_words", "repeated_words"),
    "v1": tuple(RULES),
    "v2": ("few_words", "repeated_words", "short_words", "long_words", "symbols", "duplicate_lines", "few_letters", "shouting"),
}


def mask(policy: str | tuple[str, ...]) -> int:
    return reduce(lambda a, b: a | b, (BITS[r] for r in (POLICIES[policy] if isinstance(policy, str) else policy)), 0)


def n_repeat_words(ws: Column) -> Column:
    """Words that stand in a window of 8 words found twice or more, first finding included.

    ``ws`` must be a column, not an expression: it is referred to many times."""
    n = F.size(ws)
    starts = F.sequence(F.lit(1), F.greatest(n - (WINDOW - 1), F.lit(1)))
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(ws, i, F.lit(WINDOW))))
    windows = lambda hs: F.transform(hs, lambda h, i: F.struct(h.alias("h"), (i + 1).alias("i")))
    # neighbours in the sorted order: a window repeats if the one before or after it is equal
    repeated = lambda s: F.transform(F.filter(F.arrays_zip(
        s.alias("x"), F.concat(F.array(F.lit(None).cast("bigint")), F.transform(s, lambda x: x["h"])).alias("before"),
        F.concat(F.transform(F.slice(s, 2, F.greatest(F.size(s), F.lit(1))), lambda x: x["h"]), F.array(F.lit(None).cast("bigint"))).alias("after")),
        lambda z: z["x"].isNotNull() & (z["x"]["h"].eqNullSafe(z["before"]) | z["x"]["h"].eqNullSafe(z["after"]))), lambda z: z["x"]["i"])
    # each repeated window adds the words up to the next one, 8 at most
    covered = lambda p: F.when(F.size(p) == 0, F.lit(0).cast("long")).otherwise(F.aggregate(F.zip_with(p, F.concat(F.slice(p, 2, F.greatest(F.size(p), F.lit(1))), F.array(F.lit(1 << 30))),
                                               lambda a, b: F.least(b - a, F.lit(WINDOW)).cast("long")), F.lit(0).cast("long"), lambda acc, x: acc + x))
    let = lambda value, body: F.element_at(F.transform(F.array(value), body), 1)  # noqa: E731  evaluated once, used often
    none = F.lit(0).cast("long")
    # most texts repeat no window: only the others are sorted
    found = let(hashes, lambda hs: F.when(F.size(F.array_distinct(hs)) == F.size(hs), none).otherwise(
        let(F.sort_array(windows(hs)), lambda s: let(F.sort_array(repeated(s)), covered))))
    return F.when(n < WINDOW + 1, none).otherwise(found)


def measurements(docs: DataFrame, text_col: str = "text", name: str = "m") -> DataFrame:
    """``docs`` with a struct column ``name``, no name of theirs, of long measurements (null text: as empty)."""
    t, w, l, j = unused(docs, "_t", "_w", "_l", "_j")
    text, ws, lines, joined = (F.col(c) for c in (t, w, l, j))
    d = docs.withColumn(t, F.coalesce(F.col(text_col), F.lit("")))
    d = d.withColumn(w, words(text))
    d = d.withColumn(l, F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    d = d.withColumn(j, F.translate(text, " \t\n\x0b\x0c\r", ""))
    count = lambda c: c.cast("long")
    m = {
        "n_words": count(F.size(ws)),
        "word_chars": count(F.length(joined)),
        "n_symbols": count(F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))),
        "n_lines": count(F.size(lines)),
        "n_dup_lines": count(F.size(lines) - F.size(F.array_distinct(lines))),
        "n_repeat_words": n_repeat_words(ws),
        "n_letters": count(F.length(joined) - F.length(F.regexp_replace(joined, r"\p{L}+", ""))),
        "n_upper_chars": count(F.length(joined) - F.length(F.regexp_replace(joined, r"\p{Lu}+", ""))),
        "n_ellipsis_lines": count(F.size(F.filter(lines, lambda x: x.rlike(r"(\.\.\.|…)\s*$")))),
        "n_bullet_lines": count(F.size(F.filter(lines, lambda x: x.rlike(r"^\s*[-*•●]")))),
    }
    # a generator of one row: no filter on the measurements is moved below it, so each is computed
    # once whatever is done with it later
    one = F.explode(F.array(F.struct(*[c.alias(k) for k, c in m.items()]))).alias(name)
    return d.select(*own(docs), one)


def _judged(docs: DataFrame, text_col: str, fails: str, m: str) -> DataFrame:
    """``docs`` with the columns ``fails`` and ``m``, no names of theirs."""
    d = measurements(docs, text_col, m)
    get = lambda name: F.col(m)[name]
    bits = [F.when(test(get), F.lit(BITS[name]).cast("long")).otherwise(F.lit(0).cast("long")) for name, (test, _) in RULES.items()]
    return d.select(*own(docs), reduce(lambda a, b: a.bitwiseOR(b), bits).alias(fails), m)


def ledger(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with ``m`` (struct of measurements) and ``fails`` (long, one bit a rule).

    A null or empty text has zero everywhere and fails ``few_words`` only; repeated rows are
    judged each; an empty table gives an empty ledger.  The two new columns replace columns of
    the same names (in any letter case); all others keep name and value."""
    return _judged(docs.select(*own(docs, ("fails", "m"))), text_col, "fails", "m")


def passing(docs: DataFrame, *policies: str | tuple[str, ...], text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass every policy, all their columns as they are (``fails`` and ``m`` too)."""
    fails, m = unused(docs, "fails", "m")
    led = _judged(docs, text_col, fails, m)
    return led.filter(reduce(lambda a, b: a & b, [verdict(F.col(fails), p) for p in policies])).select(*own(docs))


def verdict(fails: Column, policy: str | tuple[str, ...]) -> Column:
    """True where a document passes every rule of the policy."""
    return fails.bitwiseAND(F.lit(mask(policy)).cast("long")) == 0


def ablations(led: DataFrame, policy: str | tuple[str, ...]) -> DataFrame:
    """One row a rule of the policy: documents that fail it, that fail it alone (kept if the rule
    went) and that the policy keeps, from the ledger's bits in one aggregate."""
    names = POLICIES[policy] if isinstance(policy, str) else policy
    hit = F.col("fails").bitwiseAND(F.lit(mask(policy)).cast("long"))
    per = led.groupBy(hit.alias("bits")).agg(F.count(F.lit(1)).alias("n"))  # at most 2 ** rules rows
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BITS[r]).cast("long").alias("bit")) for r in names])
    rows = per.select("bits", "n", F.explode(rules).alias("r"))
    n = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))
    bit = F.col("r.bit")
    return rows.groupBy(F.col("r.rule").alias("rule")).agg(
        n(F.col("bits").bitwiseAND(bit) != 0).alias("failed"), n(F.col("bits") == bit).alias("failed_alone"),
        n(F.col("bits") == 0).alias("kept"), F.bit_or("bits").alias("rules_seen"))
