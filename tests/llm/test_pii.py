import hashlib
import random
import re

import pytest

from lumentide.llm import pii

#: The base patterns as the contract words them.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def base(text):
    out = []
    for k, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (12 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return [x for _, _, x in sorted(out)]


def odd_texts():
    r = random.Random(6)
    yield from [None, "", "a@b.c_d@e.f", "a@b..c x@y.z.", "1.2.3.4.5.6.7.8 256.1.1.1 0255.1.1.1", "+1 (23) 456-78-9", "++12 345 6789 0+4999", "4111 1111 1111 1111", "é😀 x@y.de 10.0.0.1", "1" * 5000, "a@b" + ".c" * 5000, "9" * 12 + "-" + "9" * 9, "+" * 3000, "%@-.-", "@a.b", "4111-1111-1111-1111 4111 1111 1111 1112"]
    pieces = [" ", "-", ".", "@", "+", "a", "b", "_", "1", "2", "25", "255", "4111111111111111", "é", "😀", "x@y.z", "10.0.0.1", "(", ")", "\n", "1234 5678 9"]
    for _ in range(700):
        yield "".join(r.choice(pieces) for _ in range(r.randint(1, 30)))


def test_base_spans_against_the_plain_patterns(spark):
    texts = list(odd_texts())
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    out = {r.doc_id: r for r in pii.find(docs).collect()}
    assert len(out) == len(texts)
    for i, t in enumerate(texts):
        want = base(t)
        assert out[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), (t, want, out[i].spans)
        spans = out[i].spans.split(",") if out[i].spans else []
        assert set(want) <= set(spans) and len(spans) == len(want) + out[i].n_added
        assert [out[i].n_email, out[i].n_ip, out[i].n_card, out[i].n_phone] == [sum(w.startswith(k + ":") for w in want) for k in PLAIN]


def test_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = {r.doc_id: ",".join(base(r.text)) for r in docs.collect()}
    got = {r.doc_id: r.base_sha256 for r in pii.find(docs).collect()}
    assert got == {d: hashlib.sha256(w.encode()).hexdigest() for d, w in want.items()}
    assert any(want.values())


def test_boosting_tells_real_from_lookalike():
    counts = [({"generator": g, "valid": v, "digits": d, "groups": 2, "cue": c, "glued": 0, "letters": 0, "wide": 0}, g, 50.0 * v, 50.0 * (1 - v)) for g in range(4) for v in (0, 1) for d in (9, 16) for c in (0, 1)]
    model = pii.boost(counts)
    pii.calibrate(model, counts)
    assert all((model.logit(x) >= model.thresholds[k]) == bool(x["valid"]) for x, k, _, _ in counts)
    assert pii.boost(counts[:1]).thresholds == {}


@pytest.mark.parametrize(("text", "spans"), [("write to jane.doe [at] example (dot) org today", "email:9:40"), ("tel (030) 555-1234, thanks", "phone:4:18"), ("ssn 123-45-6789.", "ssn:4:15"), ("ssn 123-45-6789 here", "ssn:4:15"), ("ssn 000-45-6789 here", ""), ("pay to DE89370400440532013000 now", "iban:7:29"), ("pay to DE88370400440532013000 now", ""), ("host 2001:0db8:85a3:0000:0000:8a2e:0370:7334 up", "ip6:5:44")])
def test_added_spans(spark, text, spans):
    rows = [(0, text)] + [(i, t) for i, t in enumerate(["1.2.3.4", "300.2.3.4", "4111111111111111", "4111111111111112", "a@b.de", "+49 30 1234567", "+1 2", "999.1.1.1"] * 40, 1)]
    out = {r.doc_id: r.spans for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[0] == spans


def test_empty(spark):
    assert pii.find(spark.createDataFrame([], "doc_id long, text string")).count() == 0
