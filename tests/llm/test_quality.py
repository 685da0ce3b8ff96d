"""The ledger's measurements against brute force, policies and ablations."""
import re
from collections import Counter

from pyspark.sql import functions as F

from zonelens.llm import quality
from zonelens.llm.common import read

from .conftest import SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    ws = WORD.findall(text)
    windows = [tuple(ws[i:i + 8]) for i in range(len(ws) - 7)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
    lines, seen, dup = text.split("\n"), set(), 0
    for x in lines:
        if WORD.search(x):
            dup += x in seen
            seen.add(x)
    return len(ws), sum(map(len, ws)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered)


def rows_of(led):
    return [(r.doc_id, tuple(r.x)) for r in led.select("doc_id", F.array(*[f"m.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]).alias("x")).collect()]


def test_documents_match_brute_force(spark):
    docs = read(spark, SF, "documents")
    want = sorted((r.doc_id, brute(r.text)) for r in docs.collect())
    assert sorted(rows_of(quality.ledger(docs))) == want


def test_edge_cases(docs_of):
    run = "a b c d e f g h"
    texts = [None, "", " \t\n", run, f"{run} {run}", "x " * 9, "x " * 8, f"{run} i {run}", "é# ü|\né# ü|\n\n \n", "w" * 300_000, "k l m n o p q r s " * 5000]
    docs = docs_of(list(enumerate(texts)))
    led = quality.ledger(docs)
    assert sorted(rows_of(led)) == [(i, brute(t)) for i, t in enumerate(texts)]
    assert led.columns.count("m") == 1 and "size" in led.columns
    assert quality.ledger(docs.limit(0)).count() == 0
    bits = {r.doc_id: r.fails for r in led.collect()}
    assert bits[0] == bits[1] == quality.BITS["few_words"]
    assert bits[10] & quality.BITS["repeated_words"]


def test_policies_and_ablations(docs_of):
    clean = " ".join(f"word{i} and more text" for i in range(10))
    docs = docs_of([(1, clean), (2, "too short"), (3, "x " * 50), (4, clean + "".join(f" #{i}#" for i in range(40)))])
    led = quality.ledger(docs)
    kept = {v: sorted(r.doc_id for r in led.filter(quality.verdict(F.col("fails"), v)).collect()) for v in quality.POLICIES}
    assert kept == {"base": [1, 4], "v1": [1], "v2": [1]}
    table = {r.rule: (r.failed, r.failed_alone, r.kept) for r in quality.ablations(led, "v2").collect()}
    rows = [r.fails & quality.mask("v2") for r in led.collect()]
    for rule in quality.POLICIES["v2"]:
        bit = quality.BITS[rule]
        assert table[rule] == (sum(bool(x & bit) for x in rows), sum(x == bit for x in rows), sum(x == 0 for x in rows))


def test_plan_has_no_shuffle_or_python(spark):
    plan = quality.ledger(read(spark, SF, "documents"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
