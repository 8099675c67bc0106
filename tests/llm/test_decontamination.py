import random

import numpy as np
import pytest

from lumentide.llm import decontamination as D
from lumentide.llm.decontamination import Index, leaks, plain


def edit_distance_anywhere(pattern, text):
    """Least edits that turn the pattern into some part of the text."""
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for i, p in enumerate(pattern, 1):
            new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (p != c)))
        row = new
        best = min(best, row[-1])
    return best


def edited(r, text, edits):
    t = list(text)
    for _ in range(edits):
        k = r.randrange(len(t))
        t[k : k + r.randint(0, 1)] = [r.choice("abcdefgh ")] * r.randint(0, 2)
    return "".join(t)


def test_search_finds_what_brute_force_finds():
    r = random.Random(4)
    words = ["".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(300)]
    prose = lambda n: " ".join(r.choice(words) for _ in range(n))
    items = [(k, prose(r.randint(6, 50))) for k in range(25)] + [(90, "short"), (91, "")]
    texts = []
    for _ in range(60):
        item = r.choice(items[:25])[1]
        start = r.randrange(max(1, len(item) - 64))
        texts.append(prose(r.randint(0, 30)) + " " + edited(r, item[start : start + 64], r.randint(0, 9)) + " " + prose(r.randint(0, 30)))
    texts = [plain(t) for t in texts] + ["", "a"]
    index = Index(items)
    got = {(t, w): e for t, w, e, _, _ in index.search(texts)}
    for t, text in enumerate(texts):
        for w in range(len(index.item)):
            pattern = "".join(map(chr, index.code[w][: index.length[w]]))
            least = edit_distance_anywhere(pattern, text)
            assert ((t, w) in got) == (least <= index.edits[w]), (t, w, least)
            if (t, w) in got:
                assert got[t, w] == least


def test_tables(spark):
    sf = "/root/testdata/sf0.01"
    docs, bench = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    got = {(r.doc_id, r.item_id): r for r in leaks(docs, bench).collect()}
    items = {r.item_id: plain(r.text) for r in bench.collect()}
    for d in docs.collect():
        text = plain(d.text)
        for k, item in items.items():
            if item in text:
                assert got[d.doc_id, k].matched == got[d.doc_id, k].windows and text[got[d.doc_id, k].start : got[d.doc_id, k].stop] == item
    share = len({d for d, _ in got}) / docs.count()
    assert 0 < share < 0.1


@pytest.mark.parametrize("chars", [D.ITEM_CHARS, 40])
def test_edges_and_blocks(spark, monkeypatch, chars):
    monkeypatch.setattr(D, "ITEM_CHARS", chars)
    item = "the quick brown fox jumps over the lazy dog and runs away from there"
    other = "colourless green ideas sleep furiously in the garden of forking paths"
    docs = spark.createDataFrame([(1, None, 5), (2, "", 5), (3, "x " * 50_000 + item.upper() + " y" * 50_000, 5), (None, item, 5), (4, other.replace(" ", "\n\t "), 5), (4, other, 5)], "doc_id long, text string, item_id long")
    bench = spark.createDataFrame([(7, item), (8, None), (None, item), (9, "tiny"), (10, other), (10, other)], "item_id long, text string")
    got = sorted(((r.doc_id, r.item_id) for r in leaks(docs, bench).collect()), key=str)
    assert got == [(3, 7), (4, 10), (None, 7)]
    assert leaks(docs.limit(0), bench).count() == 0 and leaks(docs, bench.limit(0)).count() == 0
    assert np.all(Index([(1, item)]).bound > 1)
