"""Spelling variants against brute force over the given documents, long and odd words, edge cases."""
import re
import zlib
from collections import Counter, defaultdict

import pytest

from zonelens.llm import spelling
from zonelens.llm.common import read

from .conftest import SF

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_length=7, misspelt=31):
    """(id, text) rows -> {word: (form, root, n, n_near, form_n)}, near words by all strings one edit away."""
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(FOLD)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if misspelt and h % misspelt == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= min_length and c >= 2}
    near = defaultdict(set)
    at = defaultdict(list)
    for w in n:
        for k in range(len(w)):
            if (less := w[:k] + w[k + 1:]) in n:
                near[w].add(less), near[less].add(w)
            at[w[:k], w[k + 1:]].append(w)
    for same in at.values():
        for w in same:
            near[w].update(x for x in same if x != w)
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n[form[w]] if form[w] is not None else None)
    return out


def result(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_documents_match_brute_force(spark, sf):
    docs = read(spark, sf, "documents")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    got = result(spelling.variants(docs))
    assert got == want and any(v[0] for v in want.values()) and any(v[3] > 1 for v in want.values())


def test_edits_at_every_place_chains_and_ties(docs_of):
    base = "abcdefghij"
    near = {base[:k] + "z" + base[k + 1:] for k in range(10)} | {base[:k] + base[k + 1:] for k in range(10)} | {base[:k] + "q" + base[k:] for k in range(11)}
    far = ["abcdefghi" + "jkl", "zbcdefghiz", "bacdefghij", "aabbccddee", "abbccddee", "aabbccdde", "ééééééé", "éééééééé", "éééééééa"]
    words = Counter({base: 400, **{w: 3 for w in near}, **{w: 5 for w in far}})
    words |= Counter({"chainedword": 2, "chainedwora": 20, "chainedaora": 200, "chaiaedaora": 2000, "tiedwordsx": 2, "tiedwordsa": 40, "tiedwordsé": 40})
    rows = [(1, " ".join(w for w, c in words.items() for _ in range(c)))]
    got = result(spelling.variants(docs_of(rows), misspelt=None))
    assert got == brute(rows, misspelt=None)
    assert got[base][3] == len(near) and all(got[w][0] == base for w in near)
    assert got["chainedword"][:2] == ("chainedwora", "chaiaedaora") and got["tiedwordsx"][0] == "tiedwordsa"


def test_very_long_words_and_every_length(docs_of):
    long = "ab" * 20_000
    rows = [(1, f"{long} {long} {long[:-1]} {long[:-1]} {long[:30_000]}x{long[30_000:]} a a b b ab ab abc abc bc bc"), (2, f"{long[:30_000]}x{long[30_000:]}"), (3, "a b")]
    got = result(spelling.variants(docs_of(rows), min_length=1, misspelt=None))
    assert got[long][3] == 2 and got["ab"][3] == 3 and got["a"][3] == 2 and got["a"][2] == 3


def test_edge_cases(docs_of):
    text = "Straße STRASSE naïveté NAÏVETÉ Naïveté ÀÀÀÀÀÀÀÀ àààààààà x×x×x×x÷÷ "
    rows = [(1, None), (2, ""), (3, "  .,;"), (None, text), (4, text), (4, text), (5, "word " * 50_000), (6, "sevenab sevenac " * 3), (7, "once-only")]
    docs = docs_of(rows)
    out = spelling.variants(docs)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert result(out) == brute(rows)
    assert result(spelling.variants(docs.limit(0))) == {}
    assert result(spelling.variants(docs_of([(1, "Different words everywhere")]))) == {}
