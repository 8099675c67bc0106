import random
import re
from itertools import combinations

import numpy as np
import pytest

from lumentide.llm import ngram_join
from lumentide.llm.common import Scratch
from lumentide.llm.linking import bucket_pairs, connected_components, linked_components
from lumentide.llm.ngram_join import near_duplicates, shown_words


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows):
    """doc_id -> (set size, smallest doc_id reached), by comparing all pairs that share a shingle."""
    sets = {}
    for doc, text in rows:
        w = words_of(text)
        sets[doc] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    holders = {}
    for doc, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(doc)
    parent = {d: d for d in sets}

    def find(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for a, b in {p for h in holders.values() for p in combinations(sorted(h), 2)}:
        common = len(sets[a] & sets[b])
        if 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {d: (len(s), find(d)) for d, s in sets.items()}


def made_rows():
    r = random.Random(3)
    vocab = [f"w{i}" for i in range(400)]
    rows = [(1, None), (2, ""), (3, " \n "), (4, "One two"), (5, "one TWO"), (6, "one two three four"), (7, "x " * 9000), (8, "x " * 12)]
    doc = 10
    passage = [r.choice(vocab) for _ in range(60)]
    for _ in range(60):  # share a passage, else differ
        rows.append((doc, " ".join([r.choice(vocab) for _ in range(r.randint(5, 90))] + passage)))
        doc += 1
    for size in (7, 12, 20, 40, 80, 150, 400):
        base = [r.choice(vocab) for _ in range(size)]
        for _ in range(25):
            w = list(base)
            for _ in range(r.randint(0, max(1, size // 25))):
                k = r.randrange(len(w))
                w[k : k + r.randint(0, 1)] = [r.choice(vocab)] * r.randint(0, 2)
            rows.append((doc, " ".join(w)))
            doc += 1
    base = [r.choice(vocab) for _ in range(100)]
    for k in range(60):  # a chain: neighbours link, ends do not
        rows.append((doc, " ".join(base)))
        base = [*base[6:], *[r.choice(vocab) for _ in range(6)]]
        doc += 1
    return rows


def test_any_linked_pair_shows_a_common_word():
    r = np.random.default_rng(1)
    for n in [1, 2, 3, 4, 5, 7, 8, 15, 16, 17, 40, 64, 70, 200, 300, 1000, 1100]:
        for _ in range(12):
            a = r.integers(0, 1 << 63, n).astype(np.uint64)
            most = n // 7
            drop, add = r.integers(0, most + 1), r.integers(0, most + 1)
            b = np.concatenate([a[drop:], r.integers(0, 1 << 63, add).astype(np.uint64)])
            common = n - drop
            if 100 * common < 75 * (n + len(b) - common):
                continue
            show = lambda s: set(shown_words(np.sort(s), (np.sort(s) % np.uint64(3) * np.uint64(9)).astype(np.uint8)).tolist())
            assert show(a) & show(b), (n, drop, add)


def test_against_brute_force(spark, monkeypatch):
    rows = made_rows()
    monkeypatch.setattr(ngram_join, "FREQUENT", 20)
    out = near_duplicates(spark.createDataFrame([(d, t, d) for d, t in rows], "doc_id long, text string, component_id long").repartition(5)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == brute(rows)
    assert len(out) == len(rows)


def test_same_without_frequent_shingles(spark, monkeypatch):
    rows = made_rows()
    monkeypatch.setattr(ngram_join, "FREQUENT", 10**9)
    out = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out} == brute(rows)


def test_tables(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()])
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs).collect()} == want


def test_edges(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    rows = [(None, "a b c d e f"), (None, None), (4, "a b c d e f"), (4, "a b c d e f"), (9, "A b c d e f")]
    out = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id or 0), r.n_shingles, r.component_id) for r in out if r.doc_id) == [(4, 2, 4), (4, 2, 4), (9, 2, 4)]
    assert sorted(r.n_shingles for r in out if r.doc_id is None) == [0, 2] and all(r.component_id is None for r in out if r.doc_id is None)


@pytest.mark.parametrize("small", [2, 5, 50])
def test_bucket_pairs_and_rounds(spark, small):
    r = random.Random(small)
    rows = [(r.randint(0, 30), r.randint(0, 200)) for _ in range(900)]
    frame = spark.createDataFrame(rows, "key long, node long")
    groups = {}
    for k, n in rows:
        groups.setdefault(k, set()).add(n)
    got = bucket_pairs(frame, small).collect()
    want = {p for g in groups.values() for p in (combinations(sorted(g), 2) if len(g) <= small else ((min(g), x) for x in g if x != min(g)))}
    assert {(x.a, x.b) for x in got} == want
    linked = lambda p, n: p.where("(a + b) % 7 = 0").join(n.withColumnRenamed("node", "a"), "a", "left_semi")
    parts = linked_components(frame, lambda n: n, linked, Scratch(spark, "t"), small=small)
    edges = [p for g in groups.values() for p in combinations(sorted(g), 2) if sum(p) % 7 == 0]
    home = {n: n for g in groups.values() for n in g}
    for _ in home:
        for a, b in edges:
            home[a] = home[b] = min(home[a], home[b])
    assert {x.node: x.component for x in parts.collect()} == {n: home[n] for e in edges for n in e}


def test_components(spark):
    r = random.Random(9)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(300, 200), (200, 250), (7, 7)]
    r.shuffle(edges)
    got = {x.node: x.component for x in connected_components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "t")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(50)}, 200: 200, 250: 200, 300: 200}
    assert connected_components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "t")).count() == 0
