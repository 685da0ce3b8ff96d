"""Text cleaning and tokenising as column expressions (JVM regular expressions, run
inside whole-stage code generation, no Python per row).

Python's ``\\s``, ``\\S`` and ``\\d`` are Unicode-aware while Java's are ASCII-only, so the
classes are spelled out explicitly; the same spelling also runs unchanged in RE2 (the
SQL oracle), which is why no look-around is used."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The four cleaning patterns of the original analysis, applied in this
# order (written there with Python's Unicode classes \s, \S, \d):
#   1. http\S+|www\S+|https\S+   -> ''   (URLs)
#   2. \S*@\S*\s?                -> ''   (tokens with @, e.g. e-mail addresses)
#   3. \[\d+(?:,\s*\d+)*\]       -> ''   (bracketed numeric citations such as [1, 2])
#   4. \s+                       -> ' '  (whitespace runs)
# Python's whitespace: ASCII \t\n\v\f\r, \x1c-\x1f, space, \x85 and the Unicode
# separators (category Z); its digits are the Unicode decimal digits (Nd).
WS = r"\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\p{Z}"
SPACE = f"[{WS}]"
NON_SPACE = f"[^{WS}]"
DIGIT = r"\p{Nd}"
URL_PATTERN = f"http{NON_SPACE}+|www{NON_SPACE}+|https{NON_SPACE}+"
AT_PATTERN = f"{NON_SPACE}*@{NON_SPACE}*{SPACE}?"
CITATION_PATTERN = rf"\[{DIGIT}+(?:,{SPACE}*{DIGIT}+)*\]"
SPACE_RUN = f"{SPACE}+"
#: The runs that differ from the one blank they become.
LOOSE_SPACE = f" {SPACE}+|[{WS}&&[^ ]]{SPACE}*"

# Tokeniser rule (a stand-in for a Treebank-style word tokeniser followed by the
# "alphabetic, longer than 2" test): split on whitespace and the punctuation a
# Treebank tokeniser always splits off, drop a trailing clitic, trailing periods and
# surrounding quotes, keep tokens of 3+ letters.
SEPARATORS = f"[{WS}" + r",;:?!()\[\]{}<>" + '"' + r"|@#$%&]+"
CLITIC = r"(n't|'s|'re|'ve|'ll|'d|'m)$"
TRAILING_DOTS = r"\.+$"
QUOTES = r"^['`]+|['`]+$"
WORD = r"^\p{L}{3,}$"

# Domain stopwords added to the English list by the original analysis
DOMAIN_STOPWORDS = (
    "abstract", "introduction", "conclusion", "results", "discussion",
    "method", "methods", "study", "research", "paper", "article",
    "figure", "table", "fig", "tab", "et", "al", "doi", "elsevier",
    "copyright", "journal", "vol", "pp", "page", "author",
)


# Spark ML's default English stopwords, in their own order (a test compares
# them with ``StopWordsRemover.loadDefaultStopWords("english")``)
ENGLISH_STOPWORDS = tuple("""
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her
hers herself it its itself they them their theirs themselves what which who whom this that these
those am is are was were be been being have has had having do does did doing a an the and but if or
because as until while of at by for with about against between into through during before after
above below to from up down in out on off over under again further then once here there when where
why how all any both each few more most other some such no nor not only own same so than too very s
t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd
they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't
weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't
couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's
would
""".split())


def stopwords() -> tuple[str, ...]:
    return tuple(sorted(set(ENGLISH_STOPWORDS) | set(DOMAIN_STOPWORDS)))


def clean_text(col: Column) -> Column:
    """The four cleaning substitutions, in order.  A text without the letters that the first three begin with is left to the last."""
    c = F.regexp_replace(col, URL_PATTERN, "")
    c = F.regexp_replace(c, AT_PATTERN, "")
    c = F.regexp_replace(c, CITATION_PATTERN, "")
    marked = col.contains("http") | col.contains("www") | col.contains("@") | col.contains("[")
    return F.regexp_replace(F.when(marked, c).otherwise(col), LOOSE_SPACE, " ")


def tokens(cleaned: Column, stop: tuple[str, ...] | None = None) -> Column:
    """Lower-case, split, normalise token edges, keep alphabetic tokens of 3+ letters
    that are not stopwords (array<string>, in text order)."""
    stop = stopwords() if stop is None else stop
    parts = F.split(F.lower(cleaned), SEPARATORS)

    def edge(t: Column) -> Column:
        t = F.regexp_replace(t, TRAILING_DOTS, "")
        t = F.regexp_replace(t, CLITIC, "")
        return F.regexp_replace(t, QUOTES, "")

    def word(t: Column) -> Column:
        # most parts are letters only; the edge work is for parts that have such an edge
        edged = t.endswith(".") | t.contains("'") | t.contains("`")
        return F.when(t.rlike(WORD), t).when(edged, edge(t))

    norm = F.transform(parts, word)
    return F.filter(norm, lambda t: ~t.isin(list(stop)) & t.rlike(WORD))


def ngrams(toks: Column, n_max: int = 2) -> Column:
    """Unigrams followed by the word n-grams up to ``n_max`` (joined by a blank).

    Built by zipping shifted slices of the array, so each n-gram order costs one pass
    over the words (indexing the array inside a lambda would copy it per element)."""
    out = toks
    size = F.size(toks)
    for n in range(2, n_max + 1):
        m = size - (n - 1)
        grams = F.slice(toks, 1, F.greatest(m, F.lit(1)))
        for k in range(1, n):
            shifted = F.slice(toks, 1 + k, F.greatest(m, F.lit(1)))
            grams = F.zip_with(grams, shifted, lambda a, b: F.concat_ws(" ", a, b))
        grams = F.when(size >= n, grams).otherwise(F.array().cast("array<string>"))
        out = F.concat(out, grams)
    return out


def strip_replacement_chars(col: Column) -> Column:
    """Drop U+FFFD, which Spark substitutes for undecodable bytes (the original reader
    dropped such bytes)."""
    return F.regexp_replace(col, "\\x{FFFD}", "")
