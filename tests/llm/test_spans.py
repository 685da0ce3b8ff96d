"""Sentence spans against brute force, planted passages, edge cases."""
import random

from zonelens.llm import spans
from zonelens.llm.common import read

from .conftest import SF


def brute(rows, min_words=spans.MIN_WORDS, max_unit=spans.MAX_UNIT):
    """(id, text) rows, ids unique -> {id: removed sentences}: every run of sentences is compared as text."""
    first, found = {}, {}
    for i, text in sorted(rows):
        cut = spans.sentences(text, max_unit)
        forms = [" ".join(text[a:b].lower().split()) for a, b, _ in cut]
        for k in range(len(cut)):
            n = 2
            while k + n <= len(cut) and sum(c[2] for c in cut[k:k + n]) < min_words:
                n += 1
            if k + n <= len(cut):
                if first.setdefault(tuple(forms[k:k + n]), (i, k)) != (i, k):
                    found.setdefault(i, set()).update(range(k, k + n))
    return found


def test_documents_match_brute_force(spark):
    docs = read(spark, SF, "documents")
    rows = {r.doc_id: r.text for r in docs.collect()}
    want = brute(rows.items())
    for r in spans.dedup_spans(docs).collect():
        gone = want.get(r.doc_id, set())
        cut = spans.sentences(rows[r.doc_id])
        assert (r.n_sentences, r.n_removed, r.words_removed) == (len(cut), len(gone), sum(cut[k][2] for k in gone))
        if not gone:
            assert r.text == rows[r.doc_id]


def test_planted_passages_go_from_all_but_the_first(docs_of):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    sentence = lambda n: " ".join(word() for _ in range(n)).capitalize() + "."
    shared = " ".join(sentence(9) for _ in range(7))  # 63 words
    run_on = " ".join(word() for _ in range(90))  # no punctuation
    rows = [(i, f"{sentence(8)} {sentence(12)} {shared} {sentence(10)}") for i in range(6)]
    rows += [(10 + i, f"{sentence(30)}\n{run_on}\n{sentence(15)}") for i in range(3)] + [(20 + i, " ".join(sentence(11) for _ in range(9))) for i in range(4)]
    got = {r.doc_id: r for r in spans.dedup_spans(docs_of(rows)).collect()}
    assert got[0].n_removed == 0 and shared in got[0].text
    assert all(got[i].n_removed == 7 and not any(s in got[i].text for s in shared.split(". ")[:6]) for i in range(1, 6))
    assert got[10].n_removed == 0 and all(got[10 + i].words_removed == 90 for i in (1, 2))
    assert all(got[20 + i].n_removed == 0 for i in range(4))


def test_edge_cases(docs_of):
    text = "One two three four five six seven eight nine ten. " * 2 + "Eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty."
    rows = [(1, None), (2, ""), (3, " .\n!"), (4, text), (4, text), (5, text.upper()), (None, text), (6, "x. " * 50_000), (7, "word " * 100_000), (8, "!" * 100_000)]
    docs = docs_of(rows)
    out = spans.dedup_spans(docs)
    assert out.columns == [*docs.columns, "n_sentences", "n_removed", "words_removed"]
    got = sorted(((str(r.doc_id), r.n_sentences, r.n_removed) for r in out.collect()))
    by = {}
    for i, n, gone in got:
        by.setdefault(i, []).append((n, gone))
    assert by["1"] == [(0, 0)] and by["2"] == [(0, 0)] and by["3"][0][1] == 0
    assert len(by["4"]) == 2 and by["4"][0] == by["4"][1] and by["5"] == [(3, 3)] and by["None"] == [(3, 3)]
    assert [r.text for r in out.filter("doc_id = 1").collect()] == [None]
    assert spans.dedup_spans(docs.limit(0)).count() == 0


def test_passages_at_any_offset_go_whole(docs_of):
    """A passage that starts mid-sentence, in unpunctuated text or in text without blanks goes from its
    first to its last word."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(7))
    some = lambda n: " ".join(word() for _ in range(n))
    passages = [some(400), some(60), " ".join(some(9) + "." for _ in range(5)) + " " + some(6), some(50)]
    rows = []
    for k, p in enumerate(passages):
        for i, before in enumerate((3, 5, 17, 40)):
            rows.append((10 * k + i, f"{some(before)} {p} {some(4 + 11 * i)}"))
    han = lambda n: "".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(n))
    copied = han(60)
    rows += [(90 + i, han(7 + i) + copied + han(30)) for i in range(3)]
    got = {r.doc_id: r for r in spans.dedup_spans(docs_of(rows), extend=True).collect()}
    for i, text in rows:
        p = copied if i >= 90 else passages[i // 10]
        n = len(p) if i >= 90 else len(p.split())
        if i % 10 == 0:
            assert got[i].text == text and got[i].words_removed == 0
        else:
            before, after = text.split(p)
            assert got[i].words_removed == n and got[i].text.split() == (before + " " * (i < 90) + after).split()


def test_extension_keeps_one_copy_of_repeats(docs_of):
    text = "word " * 300
    got = {r.doc_id: r for r in spans.dedup_spans(docs_of([(1, text), (2, text), (2, text), (3, None)]), extend=True).collect()}
    assert 0 < got[1].words_removed < 300 and got[2].words_removed == 300 and got[3].words_removed == 0


def test_extension_on_documents_matches_brute_force(spark):
    """With ``extend``: the sentences of the brute force, and the words beside each stretch that equal those beside the first place."""
    docs = read(spark, SF, "documents")
    rows = {r.doc_id: r.text for r in docs.collect()}
    first, hits, cut = {}, {}, {}
    for i, text in sorted(rows.items()):
        cut[i] = spans.sentences(text)
        forms = [" ".join(text[a:b].lower().split()) for a, b, _ in cut[i]]
        for k in range(len(forms)):
            n = 2
            while k + n <= len(forms) and sum(c[2] for c in cut[i][k:k + n]) < spans.MIN_WORDS:
                n += 1
            if k + n <= len(forms) and (at := first.setdefault(tuple(forms[k:k + n]), (i, k))) != (i, k):
                hits.setdefault(i, []).append((k, n, *at))
    limit = spans.MIN_WORDS + 2 * spans.MAX_UNIT
    for r in spans.dedup_spans(docs, extend=True).collect():
        text, own = rows[r.doc_id], cut[r.doc_id]
        gone = {x for k, n, *_ in hits.get(r.doc_id, ()) for x in range(k, k + n)}
        every = [(w.start(), w.end()) for w in spans.PLAIN.finditer(text)]
        inside = {w for w in range(len(every)) if any(own[k][0] <= every[w][0] < own[k][1] for k in gone)}
        more = set()

        def word_at(parts, words, unit):
            return next((j for j, w in enumerate(words) if unit < len(parts) and w[0] == parts[unit][0]), len(words))

        for k, n, fi, fk in hits.get(r.doc_id, ()):
            there = [(w.start(), w.end()) for w in spans.PLAIN.finditer(rows[fi])]
            for unit, funit, step in ((k, fk, -1), (k + n, fk + n, 1)):
                if (unit - 1 if step < 0 else unit) in gone:
                    continue
                a, b = word_at(own, every, unit), word_at(cut[fi], there, funit)
                a, b = (a - 1, b - 1) if step < 0 else (a, b)
                for _ in range(limit):
                    if not (0 <= a < len(every) and 0 <= b < len(there)) or text[slice(*every[a])].lower() != rows[fi][slice(*there[b])].lower():
                        break
                    more.add(a)
                    a, b = a + step, b + step
        more -= inside
        assert (r.n_removed, r.words_removed) == (len(gone), len(inside) + len(more))
        assert r.text.split() == [text[a:b] for w, (a, b) in enumerate(every) if w not in inside and w not in more]


def test_clashing_names_keep_their_values(spark):
    names = "_cut _key key row doc text2 a b at n h lost sides count id stretch N_Removed".split()
    text = "One two three four five six seven eight nine ten. " * 4
    df = spark.createDataFrame([(i, text, *(f"{c}{i}" for c in names)) for i in (1, 2)], ["doc_id", "text", *names])
    for extend in (False, True):
        out = spans.dedup_spans(df, extend=extend)
        assert out.columns == ["doc_id", "text", *names[:-1], "n_sentences", "n_removed", "words_removed"]
        assert all(r[c] == f"{c}{r.doc_id}" for r in out.collect() for c in names[:-1])
