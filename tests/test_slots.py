"""Sweeps by slots of time against plain loops, and tables that queries prune."""

import random

import pytest
from pyspark.sql import functions as F

from lumentide.operators import boundaries
from lumentide.plans import gates
from lumentide.policy import DAY, HOUR
from lumentide.stored import Scratch


@pytest.mark.parametrize("width", [HOUR // 2, 5 * HOUR, 3 * DAY])
def test_levels_and_steps_over_slots(spark, width):
    r = random.Random(width)
    rows = [(key, at, r.randrange(5), r.randrange(5)) for key in ("a", "b") for at in {r.randrange(width) for _ in range(120)} | {0, HOUR, width}]
    rows.append(("alone", 7, 1, 0))
    points = spark.createDataFrame(rows, "k string, boundary_ms long, opens int, closes int")
    want, spans = set(), set()
    for key in ("a", "b", "alone"):
        level, before = 0, None
        for _, at, o, c in sorted(x for x in rows if x[0] == key):
            if before is not None:
                spans.add((key, before, at, level))
            level, before = level + o - c, at
            want.add((key, at, level))
    got = [tuple(x) for x in boundaries.curve(points, ("k",)).collect()]
    assert len(got) == len(rows) and set(got) == want
    assert sorted(map(tuple, boundaries.steps(points, ("k",)).collect())) == sorted(spans)
    assert boundaries.steps(points.limit(0), ("k",)).count() == 0


def test_buckets_of_the_total(spark):
    points = spark.createDataFrame([(0, 10, 2, 0), (0, 3 * HOUR, 0, 1), (0, 5 * HOUR + 1, 0, 1)], "rollup_mask int, boundary_ms long, opens int, closes int")
    got = {x.bucket_ms // HOUR: (x.peak, x.active_ms) for x in boundaries.bucket_metrics(points, HOUR // 2, 7 * HOUR, HOUR).collect()}
    assert got == {0: (2, HOUR), 1: (2, 2 * HOUR), 2: (2, 2 * HOUR), 3: (1, HOUR), 4: (1, HOUR), 5: (1, 1), 6: (0, 0)}


def test_windows_of_sweeps_are_by_slot(spark):
    points = spark.range(9).selectExpr("0 as rollup_mask", "id * 1000000 as boundary_ms", "1 as opens", "0 as closes")
    plan = boundaries.curve(points, ("rollup_mask",))._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.split("\n") if line.strip(" +-:|").startswith("Window")]
    assert windows and all("slot" in w for w in windows)


def test_written_tables_are_read_by_folder(spark):
    scratch = Scratch(spark, "test")
    rows = spark.createDataFrame([(0, 1), (5, 2), (5, 3)], "rollup_mask int, n int")
    kept = scratch.write(rows, "rollup_mask")
    assert sorted(x.n for x in kept.where("rollup_mask = 5").collect()) == [2, 3]
    files = {x.f for x in kept.where("rollup_mask = 5").select(F.input_file_name().alias("f")).collect()}
    assert files and all("rollup_mask=5" in f for f in files)
    scratch.drop(kept)


def test_checks_of_one_pass(spark):
    rows = gates.gate_rows(spark.range(3), ("three", F.count("*"), 3), ("sum", F.sum("id"), 4), ("nothing", F.max(F.lit(None).cast("long")), 0))
    assert sorted(map(tuple, rows.collect())) == [("nothing", 0, True), ("sum", 3, False), ("three", 3, True)]


def test_small_tables_go_to_few_files(spark):
    from lumentide.stored import FILE_ROWS, Scratch

    scratch, rows = Scratch(spark, "t"), spark.range(0, 1000, 1, 16)
    few, many, wide = scratch.write(rows, rows=1000), scratch.write(rows), scratch.write(rows, rows=FILE_ROWS * 2 + 1)
    assert [len(t.inputFiles()) for t in (few, many, wide)] == [1, 16, 3]
    assert few.count() == many.count() == wide.count() == 1000
    assert scratch.write(rows.limit(0), rows=0).count() == 0
