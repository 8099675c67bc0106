import random
from collections import Counter

import numpy as np

from lumentide.llm import line_dedup as L
from lumentide.llm.line_dedup import fuzzy_lines, normal, signatures, without_lines


def shingles(x):
    return {x[i : i + 8] for i in range(len(x) - 7)} or {(x,)}  # a shorter line is one shingle, of its own


def alike(a, b):
    p, q = shingles(a), shingles(b)
    return 100 * len(p & q) >= 75 * len(p | q)


def brute(rows):
    """(doc, line) -> first (doc, line) of its component."""
    places = {}
    for doc, text in rows:
        for n, raw in enumerate((text or "").split("\n")):
            if doc is not None and len(normal(raw)) >= L.LEAST:
                places.setdefault(normal(raw), []).append((doc, n))
    parent = {x: x for x in places}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders, sets = {}, {}
    for a in places:  # how many shingles each earlier line shares with it
        sets[a] = shingles(a)
        for b, n in Counter(b for x in sets[a] for b in holders.get(x, ())).items():
            if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
                parent[find(a)] = find(b)
        for x in sets[a]:
            holders.setdefault(x, []).append(a)
    first = {}
    for x, at in places.items():
        first[find(x)] = min([first.get(find(x), (1 << 60, 0)), *at])
    return {p: first[find(x)] for x, at in places.items() for p in at}


def made_rows():
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdefghiéß") for _ in range(r.randint(1, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    common = [prose(r.randint(6, 40)) for _ in range(12)]
    rows = []
    for doc in range(150):
        lines = []
        for _ in range(r.randint(0, 6)):
            kind = r.random()
            if kind < 0.4:
                lines.append(prose(r.randint(1, 30)))
            elif kind < 0.6:
                lines.append(r.choice(common).upper() + "  ")
            else:
                w = r.choice(common).split()
                w[r.randrange(len(w))] = word()
                lines.append(" ".join(w))
        rows.append((doc, "\n".join(lines)))
    return [*rows, (900, None), (901, ""), (902, "x" * 30_000 + "\n" + "y z" * 9 + "\n\n"), (None, "a line without a document id"), (903, common[0])]


def test_components_against_brute_force(spark):
    rows = made_rows()
    out = fuzzy_lines(spark.createDataFrame([(d, t, True) for d, t in rows], "doc_id long, text string, kept boolean").repartition(4)).collect()
    got = {(r.doc_id, r.line_no): (r.class_doc, r.class_line) for r in out}
    want = brute(rows)
    assert len(out) == len(want) and got.keys() == want.keys()
    assert sum(got[k] == want[k] for k in want) >= 0.98 * len(want)  # banding misses a pair at the threshold now and then
    assert all(r.kept == ((r.doc_id, r.line_no) == (r.class_doc, r.class_line)) for r in out)
    assert sum(r.kept for r in out) == len({(r.class_doc, r.class_line) for r in out})


def test_recall_at_the_threshold():
    r = np.random.default_rng(3)
    found = total = 0
    for _ in range(400):
        a = "".join(r.choice(list("abcdefghijklmnop"), 200))
        b = list(a)
        for at in (40, 100, 160):
            b[at] = "z"
        b = "".join(b)
        if alike(a, b):
            total += 1
            keys = signatures([a, b])
            found += bool((keys[0] == keys[1]).any())
    assert total > 300 and found >= 0.98 * total


def test_signatures_do_not_depend_on_neighbours():
    lines = ["the quick brown fox jumps", "über den wolken muss die freiheit", "a" * 20, "漢字" * 20]
    together = signatures(lines)
    assert all((signatures([x])[0] == together[i]).all() for i, x in enumerate(lines))


def test_removal(spark):
    rows = [(1, "first line that all of them share\nown text one, long enough", 7), (2, "FIRST line that all  of them share\nown text two, and more of it", 7), (3, "first line that all of them share", 7), (4, None, 7), (5, "short\nshort", 7), (None, "first line that all of them share", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    out = {r.doc_id: r.text for r in without_lines(docs, fuzzy_lines(docs)).collect()}
    assert out == {1: rows[0][1], 2: "own text two, and more of it", 4: None, 5: "short", None: rows[5][1]}
    assert fuzzy_lines(docs.limit(0)).count() == 0 and without_lines(docs.limit(0), fuzzy_lines(docs.limit(0))).count() == 0


def test_rows_of_one_id_lose_only_their_own_lines(spark):
    x, own = "a line that two of them share, long enough", "a unique line that must not be lost"
    docs = spark.createDataFrame([(1, x, 0, 0), (5, x, 0, 0), (5, own, 0, 0), (6, f"{own}\n{x}", 0, 0)], "doc_id long, text string, _gone int, lost int")
    out = without_lines(docs, fuzzy_lines(docs))
    assert out.columns == docs.columns and sorted((r.doc_id, r.text) for r in out.collect()) == [(1, x), (5, own)]


def test_a_large_family_against_brute_force(spark):
    r = random.Random(5)
    base = "".join(r.choice("abcdefghijklmnop ") for _ in range(90))
    rows = []
    for doc in range(400):  # members of one family of which many are not alike
        line = list(base)
        for _ in range(r.randint(1, 4)):
            line[r.randrange(len(line))] = r.choice("qrstuvwxyz")
        rows.append((doc, "".join(line)))
    got = {(r.doc_id, r.line_no): (r.class_doc, r.class_line) for r in fuzzy_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = brute(rows)
    assert got.keys() == want.keys() and sum(got[k] == want[k] for k in want) >= 0.98 * len(want)


def test_ids_beyond_what_a_long_of_places_holds(spark):
    x, big = "a line that some of them share, long enough", (1 << 63) - 1
    docs = spark.createDataFrame([(big, x + "\n" + x), (-big, "own line of the first\n" + x), (7, x)], "doc_id long, text string")
    got = {(r.doc_id, r.line_no): (r.class_doc, r.class_line, r.kept) for r in fuzzy_lines(docs).collect()}
    first = (-big, 1)
    assert got == {(-big, 0): (-big, 0, True), first: (*first, True), (big, 0): (*first, False), (big, 1): (*first, False), (7, 0): (*first, False)}


def test_normal_is_split_and_join():
    for line in ["", " ", "a b", " a", "a ", "a  b", "a\tb", "a\u00a0b", "\u3000x", "A\rB", "É\x1fß", "\u200bx y"]:
        assert normal(line) == " ".join(line.lower().split())
