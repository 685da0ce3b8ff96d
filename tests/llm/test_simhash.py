"""Near-duplicate groups against brute force, and the edge cases."""
import random

import xxhash

from zonelens.llm import components, simhash
from zonelens.llm.common import read

from .conftest import SF


def brute_fingerprint(text):
    ws = bytes((text or "").encode()).lower().split()
    if not ws:
        return 0
    grams = [b" ".join(ws)] if len(ws) < 4 else [b" ".join(ws[i:i + 4]) for i in range(len(ws) - 3)]
    hs = [xxhash.xxh64(g, seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(fps, limit=4):
    """row -> smallest id reachable, by comparing all fingerprints."""
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i][1] ^ fps[j][1]).bit_count() <= limit:
                parent[find(i)] = find(j)
    low = {}
    for k, (i, _) in enumerate(fps):
        if i is not None:
            low[find(k)] = min(low.get(find(k), i), i)
    return [low.get(find(k)) for k in range(len(fps))]


def test_documents_match_brute_force(spark):
    docs = read(spark, SF, "documents")
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    fps = [(i, brute_fingerprint(t)) for i, t in rows]
    got = sorted((r.id, r.fp % (1 << 64), r.component_id) for r in simhash.near_duplicates(docs).collect())
    assert got == sorted((i, f, c) for (i, f), c in zip(fps, brute_components(fps)))


def test_links_find_every_pair_once(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(60)]
    fps = set(base)
    for b in base:
        for _ in range(4):
            x = b
            for bit in rng.sample(range(64), rng.randint(1, 6)):
                x ^= 1 << bit
            fps.add(x)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    nodes = spark.createDataFrame([(x,) for x in signed], "fp long")
    want = sorted((a, b) for a in signed for b in signed if a < b and ((a ^ b) % (1 << 64)).bit_count() <= 4)
    for segments in (2, 3, 4, 5):
        assert sorted((r.a, r.b) for r in simhash.links(nodes, 4, segments).collect()) == want
    assert want


def test_edge_cases(spark, docs_of):
    long = "word " * 70_000 + "end"
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "Same text here twice over"), (4, "Same text here twice over"), (5, "SAME text here twice over"),
            (None, "Same text here twice over"), (7, "two words"), (8, long), (9, long)]
    got = sorted(((r.id if r.id is not None else -1, r.fp % (1 << 64), r.component_id) for r in simhash.near_duplicates(docs_of(rows)).collect()))
    assert [(i, c) for i, _, c in got] == [(-1, 4), (1, 1), (2, 1), (3, 1), (4, 4), (4, 4), (5, 4), (7, 7), (8, 8), (9, 8)]
    assert all(f == brute_fingerprint(dict(((k if k is not None else -1), t) for k, t in rows)[i]) for i, f, _ in got)
    kept = simhash.keep_one(docs_of(rows))
    assert kept.columns == docs_of(rows).columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4, 7, 8]
    assert simhash.near_duplicates(docs_of(rows).limit(0)).count() == 0
    assert simhash.keep_one(docs_of(rows).limit(0)).count() == 0


def test_group_of_null_ids_keeps_one(docs_of):
    got = simhash.keep_one(docs_of([(None, "a b c d e f"), (None, "a b c d e f"), (None, "A b c d e f")]))
    assert got.count() == 1


def test_components_of_chains_stars_and_nothing(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 201), (201, 200)]
    rng = random.Random(1)
    rng.shuffle(edges)
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in components.components(df).collect()}
    want = {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 200, 201: 200}
    assert got == want
    assert components.components(df.limit(0)).count() == 0
