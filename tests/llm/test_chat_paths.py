"""Viterbi against all paths, markers in bodies, and conversations of any shape."""

from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumentide.llm import chat_format as C


def odds(seed):
    r = np.random.default_rng(seed)
    start, step, emit = r.random(C.STATES), r.random((C.STATES, C.STATES)), r.random((C.STATES, C.SYMBOLS))
    start[1::2] = 0
    for a in range(C.STATES):
        for b in range(1, C.STATES, 2):
            if a // 2 != b // 2:
                step[a, b] = 0
    with np.errstate(divide="ignore"):
        return C.Hmm(np.log(start / start.sum()), np.log(step / step.sum(1, keepdims=True)), np.log(emit / emit.sum(1, keepdims=True)))


def worth(m, seen, path, before=-1):
    total = m.start[path[0]] if before < 0 else m.step[before, path[0]]
    return total + sum(m.emit[s, o] for s, o in zip(path, seen, strict=True)) + sum(m.step[a, b] for a, b in zip(path, path[1:], strict=False))


@pytest.mark.parametrize("seed", range(6))
def test_viterbi_is_the_best_of_all_paths(seed):
    m, r = odds(seed), np.random.default_rng(100 + seed)
    for n in (1, 2, 3, 4, 5):
        seen = r.integers(0, C.SYMBOLS, n)
        paths = list(product(range(C.STATES), repeat=n))
        assert worth(m, seen, m.decode(seen, -1, -1).tolist()) == pytest.approx(max(worth(m, seen, p) for p in paths))
        for before, after in ((0, 4), (3, 2), (5, 5)):
            best = max(worth(m, seen, p, before) for p in paths if p[-1] == after)
            assert m.product(seen)[before, after] == pytest.approx(best)
            if np.isfinite(best):
                got = m.decode(seen, before, after).tolist()
                assert got[-1] == after and worth(m, seen, got, before) == pytest.approx(best)


def test_a_marker_unlike_the_others_is_body():
    lines = ["User: how many?", "Assistant: three", "User: and now?", "Answer: 4 and more words", "User: bye", "Assistant: bye"]
    assert C.bodies(lines, [2, 4, 2, 4, 2, 4]) == ["how many?", "three", "and now?", "Answer: 4 and more words", "bye", "bye"]
    # of markers that are as frequent, that in the shape of the others
    assert C.bodies(["### Human:", "hi", "### AI:", "Answer: 4"], [2, 3, 4, 4]) == ["", "hi", "", "Answer: 4"]
    # one of another role than the turn's
    assert C.bodies(["Question: is a word"], [4]) == ["Question: is a word"]


def spoken(out, conv):
    return [(r.role, r.text) for r in sorted((r for r in out if r.conv == conv), key=lambda r: r.turn)]


def test_turns_without_number_are_cut_by_rank(spark, monkeypatch):
    monkeypatch.setattr(C, "TURNS_A_PART", 4)
    monkeypatch.setattr(C, "FULL", 8)
    monkeypatch.setattr(C, "FAN", 3)
    monkeypatch.setattr(C, "BLOCK", 2)
    rows = [(None, None, "user", "the same")] * 150 + [(None, 1, "assistant", f"answer {i:03d}") for i in range(50)] + [(7, -i, "user", f"u{i:02d}") for i in range(40)]
    rows += [(c, t, ("user", "assistant")[t % 2], f"conversation {c} turn {t}") for c in range(20, 40) for t in range(6)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    parts = C.transcripts(turns).collect()
    assert max(len(p.roles) for p in parts) <= 8
    texts = {}
    for p in sorted(parts, key=lambda p: p.part):
        texts[p.conv] = texts.get(p.conv, "") + p.text
    assert [p.part for p in parts if p.conv == "none"].__len__() == 50 and all(len(p.roles) == 4 for p in parts if p.conv == "none")
    none = texts["none"].split("\n")
    assert sum(x.endswith("the same") for x in none) == 150
    answers = [x[-3:] for x in none if "answer " in x]
    assert answers == [f"{i:03d}" for i in range(50)]
    assert [x[-3:] for x in texts["c7"].split("\n") if x[-3:-2] == "u"] == [f"u{i:02d}" for i in range(39, -1, -1)]
    monkeypatch.setattr(C, "FULL", 10**6)
    monkeypatch.setattr(C, "TURNS_A_PART", 10**6)
    whole = {p.conv: p.text for p in C.transcripts(turns).collect()}
    assert {c: t for c, t in texts.items() if c != "none"} == {c: t for c, t in whole.items() if c != "none"}
    assert sorted(texts["none"].split("\n")) == sorted(whole["none"].split("\n"))


def test_many_keys_are_joined_by_shares(spark, monkeypatch):
    monkeypatch.setattr(C, "FULL", 2)
    monkeypatch.setattr(C, "TURNS_A_PART", 2)
    rows = [(c, None, "user", f"{c} {t}") for c in range(30) for t in range(c % 7)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    few = sorted(map(tuple, C.transcripts(turns).select("conv", "part", "text").collect()))
    monkeypatch.setattr(C, "few_enough", lambda df: False)
    assert sorted(map(tuple, C.transcripts(turns).select("conv", "part", "text").collect())) == few


def test_turn_numbers_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(C, "BLOCK", 3)
    m = C.train(C.transcripts(spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")).where(F.col("conv") != ""))
    parts = [("c1", i, f"User: question {i}?\nAssistant: answer {i}\n") for i in range(20)] + [("c2", 5, "User: late begin\n")]
    out = C.parse_transcripts(spark.createDataFrame(parts, "conv string, part long, text string"), m).collect()
    assert spoken(out, "c1") == [x for i in range(20) for x in (("user", f"question {i}?"), ("assistant", f"answer {i}"))]
    assert spoken(out, "c2") == [("user", "late begin")]
    assert sorted(r.turn for r in out if r.conv == "c1") == list(range(40))
