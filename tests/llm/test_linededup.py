"""Boilerplate lines against brute force, the near-threshold path, edge cases."""
import hashlib
import re
from collections import defaultdict

from zonelens.llm import linededup
from zonelens.llm.common import read

from .conftest import SF


def brute(rows, min_sites, min_words=1):
    """rows of (id, text, site) -> sorted (id, lines, removed, text)."""
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    drawn = {}
    for _, t, s in rows:
        own = (md5(f"{md5(t or '')}|{s or chr(0)}"), s or "\0")
        drawn[t] = min(drawn.get(t, own), own)
    site = {t: s for t, (_, s) in drawn.items()}
    key = lambda x: re.sub(r"[\x09-\x0D]", " ", x).strip(" ")
    judged = lambda x: len(re.findall(r"[^\x20\x09-\x0D]+", x)) >= min_words
    on = defaultdict(set)
    for t, s in site.items():
        for x in (t or "").split("\n"):
            if judged(x):
                on[key(x)].add(s)
    out = []
    for i, t, _ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (judged(x) and len(on[key(x)]) >= min_sites)]
        out.append((i, 0 if t is None else len(lines), len(lines) - len(kept), t if len(kept) == len(lines) else "\n".join(kept)))
    return sorted(out, key=str)


def compare(docs, min_sites):
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    got = linededup.strip_boilerplate(docs, min_sites=min_sites).collect()
    assert sorted(((r.doc_id, r.n_lines, r.n_removed, r.text) for r in got), key=str) == brute(rows, min_sites)


def test_documents_match_brute_force(spark):
    docs = read(spark, SF, "documents")
    for min_sites in (2, 5, 10):
        compare(docs, min_sites)


def test_exact_counts_near_the_threshold(docs_of):
    """Lines on every number of sites around a threshold beyond the sketch's exact range."""
    rows, i = [], 0
    for sites in range(60, 141, 4):
        for s in range(sites):
            rows.append((i, f"a line on exactly {sites} sites\nonly here number {i} of them", f"s{s}"))
            i += 1
    compare(docs_of(rows), 100)


def test_copies_carry_one_site(docs_of):
    copied = "the same document copied everywhere\nwith a second line of words"
    rows = [(i, copied, f"s{i}") for i in range(12)] + [(20 + i, f"real boilerplate line on sites\nown text of number {i}", f"s{i}") for i in range(12)]
    got = {r.doc_id: r.n_removed for r in linededup.strip_boilerplate(docs_of(rows)).collect()}
    assert all(got[i] == 0 for i in range(12)) and all(got[20 + i] == 1 for i in range(12))


def test_edge_cases(docs_of):
    line = "one two three four five"
    rows = [(i, f"{line}{' ' * i}\r\nbody {i} has other words", f"s{i}") for i in range(3)]
    rows += [(10, None, "s1"), (11, "", "s2"), (12, "\n\n", None), (13, line, None), (13, line, None), (None, f"\t{line}", "s9"),
             (14, "short one", "s1"), (15, "short one ", "s2"), (16, "w " * 200_000, "s3")]
    docs = docs_of(rows)
    compare(docs, 3)
    out = linededup.strip_boilerplate(docs, min_sites=3)
    assert out.columns == [*docs.columns, "n_lines", "n_removed"]
    assert linededup.strip_boilerplate(docs.limit(0)).count() == 0
    again = linededup.strip_boilerplate(out, min_sites=3)
    assert again.columns == out.columns


def test_the_pipeline_judges_short_lines(spark, docs_of):
    import corpus_pipeline

    rows = [(i, f"body {i} has words of its own\nAll rights reserved.", f"s{i}") for i in range(12)] + [(20 + i, f"another text number {i}\nMenu", f"s{i}") for i in range(9)]
    got = {r.doc_id: r.text for r in corpus_pipeline.line_dedup(spark, docs_of(rows), None).collect()}
    assert all(got[i] == f"body {i} has words of its own" for i in range(12)) and all(got[i] == t for i, t, _ in rows[12:])


def test_a_mirror_does_not_speak_for_all_texts(docs_of):
    """A line in 40 texts, each on a site of its own and on one mirror of small name."""
    rows = [(2 * i + k, f"shared line of the sites\nown text of number {i}", s) for i in range(40) for k, s in enumerate((f"s{i}", "a-mirror"))]
    assert all(r.n_removed == 1 for r in linededup.strip_boilerplate(docs_of(rows)).collect())


def test_clashing_names_keep_their_values(spark):
    names = "_key _bad key doc bad row kept line site h N_LINES".split()
    rows = [(i, f"shared line\nown text {i}", f"s{i}", *(f"{c}{i}" for c in names)) for i in range(12)]
    out = linededup.strip_boilerplate(spark.createDataFrame(rows, ["doc_id", "text", "source", *names]))
    assert out.columns == ["doc_id", "text", "source", *names[:-1], "n_lines", "n_removed"]
    assert all(r.text == f"own text {r.doc_id}" and all(r[c] == f"{c}{r.doc_id}" for c in names[:-1]) for r in out.collect())
