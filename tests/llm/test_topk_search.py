import pytest

from lumentide.llm import topk_search
from lumentide.llm.topk_search import top_k
from pyspark.sql import functions as F


def brute(rows, k):
    """(query_id, rank, vec_id, score) over rows (vec_id, vector), each a query of its own where its id is divisible by 10."""
    whole = [(i, [int(1024 * x // 1) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and x == x and abs(x) != float("inf") for x in v)]
    out = []
    for at, (i, q) in enumerate(whole):
        if i % 10 == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v, strict=False)), j) for n, (j, v) in enumerate(whole) if n != at)
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores[:k])]
    return sorted(out)


def run(spark, rows, k=4):
    frame = spark.createDataFrame([(i, v, 0, 0) for i, v in rows], "vec_id long, embedding array<double>, row int, v int")
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in top_k(frame.repartition(3), F.col("vec_id") % 10 == 0, k=k).collect())


@pytest.mark.parametrize("chunk, block", [(4096, 16384), (2, 16)])
def test_against_brute_force(spark, monkeypatch, chunk, block):
    monkeypatch.setattr(topk_search, "QUERIES_A_CHUNK", chunk)
    monkeypatch.setattr(topk_search, "BLOCK", block)
    import random

    r = random.Random(2)
    rows = [(i, [round(r.gauss(0, 0.3), 2) for _ in range(6)]) for i in range(60)]
    rows += [(10, rows[10][1]), (10, [1.0] * 6), (7, rows[7][1])]  # ids and rows that repeat, and ties
    rows += [(80, None), (90, [1.0, None]), (100, [float("nan")] * 6), (101, [float("inf")] * 6), (None, [9.0] * 6), (110, []), (111, [1.0, 2.0])]
    assert run(spark, rows) == brute(rows, 4)


def test_large_components_are_exact(spark):
    rows = [(10, [1.0]), (1, [1e9]), (2, [1e6]), (3, [-1e9]), (20, [3e12, 1.0]), (4, [2.0**-10, 1e9])]
    got = run(spark, rows)
    assert (10, 2, 1, 1048576000000000) in got and (10, 3, 2, 1048576000000) in got
    limit = (1 << 63) - 1
    assert got == sorted((q, r, j, max(-limit - 1, min(limit, s))) for q, r, j, s in brute(rows, 4))


def test_no_rows_and_no_queries(spark):
    assert run(spark, [(1, [1.0])]) == [] and run(spark, [(10, [1.0])]) == [] and run(spark, [(10, None)]) == []
