"""Toxicity and URL filters: held-out accuracy, exact rule parts, edge cases."""
import zlib

import numpy as np

from zonelens.llm import toxicity, urls
from zonelens.llm.common import read

from .conftest import SF

LARGER = "/root/testdata/sf0.1"


def test_toxicity_on_held_out_labels(spark):
    docs, labels = read(spark, LARGER, "documents"), read(spark, LARGER, "labels")
    model = toxicity.train(docs, labels)
    got = {r.id: r for r in toxicity.score(docs, model).collect()}
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    held = [(r.toxic, got[r.doc_id].predicted) for r in labels.collect() if got[r.doc_id].held_out]
    right = sum(a == b for a, b in held) / len(held)
    recall = sum(a == b == 1 for a, b in held) / sum(a for a, _ in held)
    precision = sum(a == b == 1 for a, b in held) / sum(b for _, b in held)
    assert right > 0.97 and recall > 0.85 and precision > 0.9


def test_label_model_recovers_accuracies():
    rng = np.random.default_rng(2)
    y = rng.random(4000) < 0.2
    rates = [(0.7, 0.02), (0.5, 0.05), (0.6, 0.01), (0.3, 0.3)]
    votes = np.array([rng.random(4000) < np.where(y, a, b) for a, b in rates]).T.astype(float)
    votes = np.column_stack([votes, votes[:, 0]])  # a copy of the first voter
    given = np.where(rng.random(4000) < 0.95, y, ~y).astype(int)
    m = toxicity.LabelModel.fit(votes, given, np.ones(4000))
    assert np.allclose(m.toxic[:4], [a for a, _ in rates], atol=0.08) and np.allclose(m.clean[:4], [b for _, b in rates], atol=0.03)
    assert m.share[0] == m.share[4] == 0.5 and m.share[1] == m.share[3] == 1
    better = ((m.posterior(votes, given) > 0.5) == y).mean()
    assert better > (given == y).mean() + 0.01


def test_toxicity_edge_cases(spark, docs_of):
    docs = docs_of([(1, None), (2, ""), (3, "you are a stupid idiot, a worthless loser"), (3, "you are a stupid idiot, a worthless loser"), (None, "fine text"), (4, "fine " * 100_000)])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for labels in (none, spark.createDataFrame([(1, 1, 0), (None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")):
        got = sorted((str(r.id), r.predicted) for r in toxicity.score(docs, toxicity.train(docs, labels)).collect())
        assert got == [("1", 0), ("2", 0), ("3", 1), ("3", 1), ("4", 0), ("None", 0)]
    model = toxicity.train(docs.limit(0), none)
    assert toxicity.score(docs.limit(0), model).count() == 0


def brute_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    path = rest[cut:]
    end = min([path.find(c) for c in "?#" if c in path], default=len(path))
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return rest[:cut].translate(lower), path[:end]


def brute_rule(host, path):
    fits = []
    for verdict, rule in urls.RULES:
        domain, _, rest = rule.partition("/")
        if (host == domain or host.endswith(f".{domain}")) and path.startswith(f"/{rest}"):
            fits.append((len(rule), rule, verdict))
    return max(fits)[1:] if fits else (None, None)


def compare(pages):
    for r in urls.judge(pages).collect():
        host, path = brute_url(r.url)
        rule, verdict = brute_rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == (verdict or ("block" if r.score >= 0.5 else "allow")) and 0 <= r.score <= 1


def test_pages_and_edge_cases(spark):
    compare(read(spark, SF, "pages").select("page_id", "url"))
    odd = [None, "", "no scheme", "http://", "://X.COM/", "http://A.B.com?x=/y", "http://com/", "http://evilcom/en/", "ftp://www.example.com/en/a://b", "http://x.example.com/en", "http://net/es/#a",
           "http://é.net/fr/ü?q", "http://a.net/fr/" + "x" * 100_000, "a\nb://h\n.com/p\nq?r", "http://a.com/x", "http://a.com/x"]
    pages = spark.createDataFrame([(i, u, "old", 1) for i, u in enumerate(odd)], "page_id long, url string, host string, score int")
    compare(pages)
    assert urls.judge(pages).columns == ["page_id", "url", "host", "path", "rule", "score", "verdict"]
    assert urls.judge(pages).count() == len(odd) and urls.judge(pages.limit(0)).count() == 0


def test_url_classifier(spark):
    model = urls.train(urls.default_labelled(spark))
    score = lambda u: model.score((at := urls.features(*brute_url(u))), [1.0] * len(at))
    assert all(score(u) < 0.5 for u in urls.GOOD) and all(score(u) >= 0.5 for u in urls.BAD)
    assert all(score(u) >= 0.5 for u in ("http://www.casino-win.example.org/en/77", "https://m.free-bets.example.org/de/1", "http://cheap-pills.example.org/fr/9.html"))
    assert all(score(u) < 0.5 for u in ("https://www.history.edu/lectures/rome", "https://blog.gardener.org/en/12"))


def test_url_classifier_on_urls_held_apart(spark):
    rows = [(u, 0) for u in urls.GOOD] + [(u, 1) for u in urls.BAD]
    right = 0
    for fold in range(4):  # each URL is judged by a model that has not seen it
        model = urls.train(spark.createDataFrame([r for k, r in enumerate(rows) if k % 4 != fold], "url string, block int"))
        right += sum((model.score(at := urls.features(*brute_url(u)), [1.0] * len(at)) >= 0.5) == y for k, (u, y) in enumerate(rows) if k % 4 == fold)
    print("held apart:", right, "of", len(rows))
    assert right >= 0.8 * len(rows)


def test_no_training_url_is_of_a_given_site(spark):
    sites = lambda found: {".".join(brute_url(u)[0].split(".")[-3:]) for u in found if u and brute_url(u)[0].count(".") > 1}
    given = [r.url for sf in ("sf0.001", "sf0.01", "sf0.1") for r in read(spark, f"/root/testdata/{sf}", "pages").select("url").collect()]
    assert not sites(given) & sites(urls.GOOD + urls.BAD)


def test_url_training_without_two_classes(spark):
    page = spark.createDataFrame([(1, "http://x.org/")], "page_id long, url string")
    labelled = lambda rows: spark.createDataFrame(rows, "url string, block int")
    judged = lambda rows: urls.judge(page, labelled=labelled(rows)).first().verdict
    assert judged([]) == "allow" and judged([("http://a.b/", 1), (None, 0)]) == "block" and judged([("http://a.b/", 0)]) == "allow"
