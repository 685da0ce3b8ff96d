"""Base places against brute force, rule resolution against brute force, edge cases."""
import re

from pyspark.sql import functions as F

from zonelens.llm import licenses
from zonelens.llm.common import read

from .conftest import SF

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute_base(text):
    ws = words(text)
    at, labels = [], set()
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        hits = [i for i in range(len(ws)) if ws[i:i + len(p)] == p]
        at += hits
        labels |= {label} if hits else set()
    return len(ws), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def brute_labels(text, table):
    t = f" {' '.join(words(text))} "
    found = [(m.start(), m.end(), r.priority, k, r.label) for k, r in enumerate(table)
             for m in re.finditer(f"(?<= )(?:{r.pattern})(?= )", t)]
    first = lambda x: (x[0], -x[1], -x[2], x[3])
    stays = [x for x in found if not any(y is not x and y[0] <= x[0] and y[1] >= x[1] and y[2] >= x[2] and first(y) < first(x) for y in found)]
    return {x[4] for x in stays}


def compare(docs):
    table = licenses.rules()
    rows = docs.select("doc_id", "text").collect()
    want = sorted((str(r.doc_id), *map(str, brute_base(r.text)), ",".join(sorted(brute_labels(r.text, table) | set(filter(None, brute_base(r.text)[4].split(","))))))
                  for r in rows)
    got = licenses.scan(docs).collect()
    assert sorted((str(r.id), str(r.n_words), str(r.n_base), str(r.first_word), str(r.last_word), r.base_labels, r.labels) for r in got) == want
    assert all(0 <= r.score <= 1 and (r.score > 0) == bool(r.labels) for r in got)


def test_documents_match_brute_force(spark):
    compare(read(spark, SF, "documents"))


def test_edge_cases_and_overlaps(docs_of):
    texts = [None, "", "...", "MIT License", "mit license mit license, Apache-License! x", "the GNU General Public License, version 3 or later",
             "gnu lesser general public license version 2 1 and more", "Licensed under CC BY-NC 4.0.", "permission is hereby granted, free of charge, to any person obtaining a copy",
             "non mit licenses are not it", "ÉMIT LICENSE", "mit license " * 20_000, "Released under the MIT License. All rights reserved. Copyright (c) 2020"]
    again = [(90, "under the Mozilla Public License, version 2.0")] * 3  # a name inside a longer detection, in repeated rows
    docs = docs_of([*enumerate(texts), (3, "MIT License"), (None, "apache license"), *again])
    compare(docs)
    assert licenses.scan(docs.limit(0)).count() == 0


def test_priority_and_containment(spark):
    table = [licenses.Rule("low", "alpha", "alpha beta gamma", 1, 0.5), licenses.Rule("high", "beta", "beta", 2, 0.5), licenses.Rule("inner", "gamma", "gamma", 1, 0.5),
             licenses.Rule("wide", "gamma", "beta gamma delta", 3, 0.5)]
    texts = spark.createDataFrame([(1, " alpha beta gamma "), (2, " alpha beta gamma delta "), (3, " gamma beta ")], "key long, t string")
    found = texts.select("key", licenses.hits(F.col("t"), table).alias("found"))
    got = sorted((r.key, r.label) for r in licenses.detections(found, table).collect())
    assert got == [(1, "high"), (1, "low"), (2, "low"), (2, "wide"), (3, "high"), (3, "inner")]


def test_there_are_hundreds_of_rules():
    table = licenses.rules()
    assert len(table) >= 200 and all(r.keyword and re.compile(r.pattern) for r in table)


def test_plan_is_native(spark):
    docs = read(spark, SF, "documents")
    plan = licenses.scan(docs.select("*", F.lit(1).alias("labels")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def samples(pattern):
    """Strings that a pattern matches: every alternative, with and without every optional part."""
    from re import _parser

    def walk(tree):
        out = [""]
        for op, x in tree:
            name = str(op)
            if name == "LITERAL":
                got = [chr(x)]
            elif name == "BRANCH":
                got = [y for branch in x[1] for y in walk(branch)]
            elif name == "SUBPATTERN":
                got = walk(x[3])
            elif name in ("MAX_REPEAT", "MIN_REPEAT"):
                got = [y * n for n in sorted({x[0], min(x[1], max(x[0], 1))}) for y in walk(x[2])]
            elif name == "IN":
                got = [chr(x[0][1] if str(x[0][0]) == "LITERAL" else x[0][1][0])]
            else:
                assert name == "ANY", name
                got = ["x"]
            out = [a + b for a in out for b in dict.fromkeys(got)]
        return out

    return walk(_parser.parse(pattern))


def test_every_alternative_passes_its_own_gate():
    for r in licenses.rules():
        for text in samples(r.pattern):
            assert re.fullmatch(r.pattern, text), (r, text)
            assert f" {r.keyword}" in f" {text} " and r.anchor in f" {text} ", (r, text)


def test_short_names_are_found(docs_of):
    want = {"0BSD": "0bsd", "BSL-1.0": "boost-1.0", "MIT-0": "mit-0", "MIT": "mit", "LGPL-2.1-only": "lgpl-2.1", "LGPL-3.0": "lgpl-3.0", "AGPL-3.0-or-later": "agpl-3.0",
            "MPL-2.0": "mpl-2.0", "EPL-2.0": "epl-2.0", "CDDL-1.0": "cddl-1.0", "GFDL-1.3": "gfdl-1.3", "EUPL-1.2": "eupl", "OSL-3.0": "osl-3.0"}
    texts = [f"SPDX-License-Identifier: {name}" for name in want] + ["released under the PSF license", "the FreeBSD license", "LGPLv3", "covered by the LGPL"]
    got = {r.id: r.labels for r in licenses.scan(docs_of([*enumerate(texts)])).collect()}
    assert [got[i] for i in range(len(texts))] == [*want.values(), "python-2.0", "bsd", "lgpl-3.0", "lgpl"]
