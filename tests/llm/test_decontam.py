"""Decontamination against a plain dynamic programme, and edge cases."""
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from zonelens.llm import decontam
from zonelens.llm.common import read

from .conftest import SF


def brute(item, text):
    """Least edit distance of ``item`` to a stretch of ``text``: the whole table."""
    row = [0] * (len(text) + 1)
    for k, x in enumerate(item):
        last, row = row, [k + 1]
        for j, y in enumerate(text):
            row.append(min(last[j] + (x != y), last[j + 1] + 1, row[j] + 1))
    return min(row)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abc"), min_size=1, max_size=70), st.lists(st.sampled_from("abc"), max_size=90))
def test_myers_is_the_edit_distance(item, text):
    d, end = decontam.myers(item, text)
    assert d == brute(item, text)
    assert d == len(item) or brute(item, text[:end]) == d and (end == 0 or brute(item, text[:end - 1]) > d)


def test_pieces_cover_an_item():
    for n in range(1, 200):
        p = decontam.pieces(n)
        assert p[0][0] == 0 and p[-1][1] == n and all(a[1] == b[0] for a, b in zip(p, p[1:])) and len(p) == int(n * decontam.MAX_ERROR) + 1


def test_documents_match_brute_force(spark):
    docs, bench = read(spark, SF, "documents"), read(spark, SF, "benchmark")
    got = {(r.id, r.item): r.distance for r in decontam.matches(docs, bench).collect()}
    items = {r.item_id: decontam.tokens(r.text) for r in bench.collect()}
    texts = {r.doc_id: decontam.tokens(r.text) for r in docs.collect()}
    want = {}
    for i, words in texts.items():
        have = set(words)
        for k, item in items.items():
            e = int(len(item) * decontam.MAX_ERROR)
            if sum(w not in have for w in item) <= e and (d := brute(item, words)) <= e:
                want[i, k] = d
    assert got == want and want


def test_edited_items_are_found_up_to_the_budget(spark, docs_of):
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(300)]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.randint(5, 60)))) for k in range(30)]
    rows, want = [], {}
    for k, text in items:
        for edits in range(0, 12):
            ws = text.split()
            for _ in range(edits):
                at = rng.randrange(len(ws))
                rng.choice([lambda: ws.insert(at, "zz"), lambda: ws.pop(at) if len(ws) > 1 else None, lambda: ws.__setitem__(at, "yy")])()
            i = len(rows)
            body = rng.choices(vocabulary, k=40) + ws + rng.choices(vocabulary, k=40)
            rows.append((i, ", ".join(body).title()))
            for j, other in items:
                o = other.split()
                d = brute(o, body)
                if d <= int(len(o) * decontam.MAX_ERROR):
                    want[i, j] = d
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = docs_of(rows)
    got = {(r.id, r.item): (r.distance, r.first_word, r.end_word) for r in decontam.matches(docs, bench).collect()}
    assert {k: v[0] for k, v in got.items()} == want
    texts = {i: decontam.tokens(t) for i, t in rows}
    by = dict(items)
    for (i, k), (d, a, b) in got.items():
        assert brute(by[k].split(), texts[i][a:b]) == d
    blocks = {(r.id, r.item): r.distance for r in decontam.matches(docs, bench, block_words=100).collect()}
    assert blocks == want
    clean = decontam.drop_contaminated(docs, bench, block_words=100)
    assert sorted(r.doc_id for r in clean.collect()) == [i for i in range(len(rows)) if not any(i == x for x, _ in want)]


def test_edge_cases(spark, docs_of):
    item = "alpha beta gamma delta epsilon zeta"
    bench = spark.createDataFrame([(1, item), (2, item), (3, None), (4, ""), (5, "too short"), (None, item)], "item_id long, text string")
    docs = docs_of([(1, None), (2, ""), (3, f"x {item.upper()}!"), (3, f"x {item.upper()}!"), (None, item), (4, ("filler " * 100_000) + item), (5, "alpha beta")])
    got = sorted((str(r.id), str(r.item), r.distance) for r in decontam.matches(docs, bench).collect())
    assert got == sorted((i, k, 0) for i in ("3", "3", "None", "4") for k in ("1", "2", "None"))
    assert sorted(str(r.doc_id) for r in decontam.drop_contaminated(docs, bench).collect()) == ["1", "2", "5"]
    assert decontam.matches(docs, bench.limit(0)).count() == 0 and decontam.matches(docs.limit(0), bench).count() == 0
    assert decontam.drop_contaminated(docs, bench.limit(0)).count() == 7


def test_short_items_are_found_where_they_stand(spark, docs_of):
    bench = spark.createDataFrame([(1, "four words stand here"), (2, "One")], "item_id long, text string")
    docs = docs_of([(1, "before: four words stand, here."), (2, "four words here stand"), (3, "one"), (4, None)])
    assert sorted((r.id, r.item, r.distance) for r in decontam.matches(docs, bench).collect()) == [(1, 1, 0), (3, 2, 0)]
    assert sorted(r.doc_id for r in decontam.drop_contaminated(docs, bench).collect()) == [2, 4]
