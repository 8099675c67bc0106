import hashlib
import random
import time

from lumentide.llm import pii
from tests.llm.test_pii import base


def test_the_check_is_no_feature(spark):
    assert not {"valid", "generator"} & set(pii.LEARNT)
    rows = [(i, t) for i, t in enumerate(["card 4111111111111111", "ref#4111111111111112"] * 60)]
    model = pii.train(pii.candidates(spark.createDataFrame(rows, "doc_id long, text string")))

    def used(t):
        return {t.feature, *[f for s in t.sides for f in used(s)]} - {None}

    assert model.trees and set().union(*map(used, model.trees)) <= set(pii.LEARNT)


def test_context_decides_between_equal_formats(spark):
    rows = [(i, t) for i, t in enumerate(["card 4111111111111111", "ref#4111111111111112"] * 60, 10)]
    rows += [(0, "call (030) 555-1234 now"), (1, "ref#(030) 555-1234 now")]
    out = {r.doc_id: r.spans for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[0] == "phone:5:19"
    assert out[1] == ""


def test_a_text_of_many_matches(spark):
    parts = []
    for i in range(20_000):
        parts += [f"(030) 555-{i % 10_000:04d}", f"10.0.{i % 300}.1", f"a{i}@b.de", "DE89370400440532013000"]
    text = " ".join(parts)
    began = time.monotonic()
    row = pii.find(spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")).where("doc_id = 1").first()
    assert time.monotonic() - began < 60
    want = base(text)
    assert row.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest() and row.n_email == 20_000
    spans = row.spans.split(",")
    assert len(spans) == len(want) + row.n_added and row.n_added == 40_000  # also where no lookalike is in the corpus


def test_overlaps_against_all_pairs(spark):
    r = random.Random(3)
    rows = []
    for row in range(60):
        for g in range(9):
            at = 0
            for _ in range(r.randint(0, 5)):
                at += r.randint(0, 6)
                end = at + r.randint(1, 8)
                rows.append((row, pii.KINDS.index(pii.GENERATORS[g][0]), g, at, end, g < 4))
                at = end
    got = pii._chosen(spark.createDataFrame(rows, "row long, kind int, generator int, start long, end long, fixed boolean")).collect()
    want = []
    for a in rows:
        others = [b for b in rows if b[0] == a[0] and b is not a and b[3] < a[4] and a[3] < b[4]]
        better = [b for b in others if b[5] or (b[4] - b[3], -b[3], -b[2]) > (a[4] - a[3], -a[3], -a[2])]
        if a[5] or not better:
            want.append((a[0], a[1], a[3], a[4], a[5]))
    assert sorted(tuple(x) for x in got) == sorted(want)
