import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumentide.llm import chat_format as C


@pytest.fixture(scope="module")
def model(spark):
    parts = C.transcripts(spark.read.parquet("/root/testdata/sf0.01/conversations.parquet"))
    return C.train(parts.where(F.crc32(F.col("conv").cast("binary")) % 5 != 0))


@pytest.mark.parametrize(("line", "role", "rest"), [("User: hi", 1, "hi"), ("### Human:", 1, ""), ("<|im_start|>assistant", 2, ""), ("[A] yes", 2, "yes"), ("**Instructions:** be brief", 0, "** be brief"), ("a dog", -1, "a dog"), ("Users say: no", -1, "Users say: no")])
def test_markers(line, role, rest):
    got = C.marker(line)
    assert got[0] == role and got[1].lstrip("* ") == rest.lstrip("* ")


def test_canonical_turns_and_held_out_accuracy(spark, model):
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    parts = C.transcripts(turns)
    got = {}
    for r in C.parse_transcripts(parts, model).collect():
        assert r.canonical == f"<|{r.role}|>\n{r.text}\n<|end|>"
        got.setdefault(r.conv, {})[r.turn] = (r.role, r.text)
    want = {}
    for r in turns.orderBy("conv_id", "turn").collect():
        want.setdefault(f"c{r.conv_id}", []).append((r.role, r.text.strip()))
    assert got.keys() == want.keys()
    assert all(sorted(t) == list(range(len(t))) for t in got.values())
    held = [c for c in want if zlib.crc32(c.encode()) % 5 == 0]
    right = sum(len(set(got[c].values()) & set(want[c])) for c in held)
    assert right >= 0.75 * sum(len(want[c]) for c in held)


def test_long_conversations_decode_as_if_whole(spark, model, monkeypatch):
    monkeypatch.setattr(C, "FAN", 3)
    r = np.random.default_rng(1)
    lines = []
    for _ in range(400):
        lines.append(["User: ", "Assistant: ", "", "", ""][r.integers(5)] + "words " * int(r.integers(1, 12)) + ["", "?"][r.integers(2)])
        if r.random() < 0.2:
            lines.append("")
    cuts = [0, 3, 50, 51, 90, 180, 200, 260, 300, 301, 303, 310, len(lines)]
    parts = [("c1", i, "\n".join(lines[a:b]) + "\n") for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
    whole = [("c2", 0, "\n".join(lines))]
    # blank lines at a cut are not seen from the other side, so the whole is given with the same blanks
    out = C.parse_transcripts(spark.createDataFrame(parts + whole, "conv string, part long, text string"), model).collect()
    seen = [C.observe(t, i == 0) for i, (_, _, t) in enumerate(parts)]
    joined = np.concatenate([s for _, s in seen])
    best = model.decode(joined, -1, -1)
    turns = int((best % 2 == 0).sum())
    one = sorted((x.turn, x.role) for x in out if x.conv == "c1")
    assert len(one) == turns and [x for _, x in one] == [C.ROLES[s // 2] for s in best.tolist() if s % 2 == 0]


def test_edges(spark, model):
    rows = [(1, None, None, None, 5), (1, 2, "robot", "x\n\ny", 5), (1, 2, "robot", "x\n\ny", 5), (None, 1, "user", "User: " * 3000, 5), (3, -7, "assistant", "", 5), (4, 10**12, "user", "far", 5), (4, 3, "system", "near", 5)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, conv int")
    parts = C.transcripts(turns.drop("conv"))
    out = C.parse_transcripts(parts, model).collect()
    assert {r.conv for r in out} >= {"c1", "none", "c4"}
    assert [r.text for r in sorted((r for r in out if r.conv == "c4"), key=lambda r: r.turn)][-1].endswith("far")
    none = turns.limit(0).drop("conv")
    assert C.parse_transcripts(C.transcripts(none), C.train(C.transcripts(none))).count() == 0
