import zlib

import numpy as np
import pyarrow as pa

from lumentide.llm import toxicity
from lumentide.llm.queries import op5_toxicity


def test_features_follow_words_not_case_or_batches():
    def bag(texts):
        out = {}
        for i, _, t, b, words in toxicity.feature_runs(pa.array(texts, pa.string())):
            for x, y in zip(t.tolist(), b.tolist(), strict=True):
                out.setdefault(i + x, []).append(y)
        return {k: sorted(v) for k, v in out.items()}

    one = bag(["Éclair IDIOT, no", None, "", "éclair idiot no"])
    assert one[0] == one[3] and 1 not in one and 2 not in one
    assert bag(["x", "éclair idiot no"])[1] == one[0]
    assert len(bag(["ab abcd"])[0]) == 3  # two words and the beginning abc


def test_fit_recovers_positives_among_unlabelled():
    r = np.random.default_rng(2)
    n = 3000
    truth = r.random(n) < 0.2
    x = (r.random((n, 30)) < 0.1).astype(np.float32)
    x[truth, :5] = r.random((truth.sum(), 5)) < 0.9
    positive = truth & (r.random(n) < 0.5)
    prior = (truth & ~positive).sum() / (~positive).sum()
    w, b = toxicity.fit(x, positive, prior, decay=1e-4)
    said = x @ w + b >= 0
    assert (said == truth).mean() > 0.95


def test_query_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    out = {r.doc_id: r for r in op5_toxicity(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id").collect()
    assert sorted(out) == sorted(r.doc_id for r in docs)
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for d, r in out.items())
    labels = [(r.doc_id, r.toxic) for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if out[r.doc_id].held_out]
    said = [(out[d].predicted, t) for d, t in labels]
    found = sum(p == t == 1 for p, t in said)
    assert found >= 0.85 * sum(t for _, t in said) and found >= 0.9 * sum(p for p, _ in said)


def test_edges(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "idiot"), (3, "x " * 100000), (3, "dup")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    rows = toxicity.score(docs, toxicity.train(docs, labels)).collect()
    assert len(rows) == 5 and all(r.predicted == 0 and 0 <= r.score < 0.5 for r in rows)
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 1), (3, 0), (3, 1)], "doc_id long, toxic int")
    assert toxicity.score(docs, toxicity.train(docs, labels)).count() == 5
    assert toxicity.score(docs.limit(0), toxicity.train(docs.limit(0), labels)).count() == 0
