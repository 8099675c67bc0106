"""Checks that a build must pass: each is a row (gate, actual, passed) of a DataFrame."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumentide.operators.boundaries import KEYS, curve


def gate(rows: DataFrame, name: str, actual: Column, passes: int = 0) -> DataFrame:
    """One row: an aggregate of rows, which must equal ``passes``."""
    out = rows.agg(F.coalesce(actual.cast("long"), F.lit(0)).alias("actual"))
    return out.select(F.lit(name).alias("gate"), "actual", (F.col("actual") == passes).alias("passed"))


def gate_rows(rows: DataFrame, *checks: tuple[str, Column, int]) -> DataFrame:
    """A row for each (name, aggregate, value that passes), from one pass over rows."""
    found = [F.struct(F.lit(name).alias("gate"), F.coalesce(actual.cast("long"), F.lit(0)).alias("actual"), F.lit(passes).alias("passes")) for name, actual, passes in checks]
    out = rows.agg(F.array(*found).alias("found")).select(F.inline("found"))
    return out.select("gate", "actual", (F.col("actual") == F.col("passes")).alias("passed"))


def union(gates: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, gates)


def require(gates: DataFrame) -> None:
    """Raises with the names of the gates that fail."""
    failed = [r["gate"] for r in gates.where("not passed").collect()]
    if failed:
        raise RuntimeError(f"gates failed: {', '.join(failed)}")


def conservation(fanned: DataFrame, tier: DataFrame) -> DataFrame:
    """Per mask: milliseconds of the tier less those of the intervals."""
    a = tier.groupBy("rollup_mask").agg(F.sum("active_ms").alias("tier_ms"))
    b = fanned.groupBy("rollup_mask").agg(F.sum(F.col("end_ms") - F.col("start_ms")).alias("interval_ms"))
    return a.join(b, "rollup_mask", "full_outer").fillna(0, ["tier_ms", "interval_ms"]).select("rollup_mask", "tier_ms", "interval_ms", (F.col("tier_ms") == F.col("interval_ms")).alias("passed"))


def build_gates(intervals: DataFrame, fanned: DataFrame, points: DataFrame, tier: DataFrame, masks: tuple[int, ...], size: int) -> DataFrame:
    """The invariants that need no reference: balance, order, keys, masks, time, peaks."""
    levels = curve(points).groupBy(*KEYS).agg(F.max("level").alias("sweep"), F.count_if(F.col("level") < 0).alias("below"))
    per_key = tier.groupBy(*KEYS, "bucket_ms").agg(F.count("*").alias("n"))
    served = tier.groupBy(*KEYS).agg(F.max("peak").alias("served"))
    return union([
        gate(points, "opens equal closes", F.sum(F.col("opens") - F.col("closes"))),
        gate(intervals, "no empty interval", F.count_if(F.col("end_ms") <= F.col("start_ms"))),
        gate(per_key, "one row for each key", F.count_if(F.col("n") > 1)),
        gate_rows(
            tier,
            ("only known masks", F.count_if(~F.col("rollup_mask").isin(*masks)), 0),
            ("all masks there", F.count_distinct("rollup_mask"), len(masks)),
            ("time within peak", F.count_if(F.col("active_ms") > F.col("peak") * size), 0),
            ("ending within peak", F.count_if(F.col("ending_concurrency") > F.col("peak") + F.col("boundary_points")), 0),
        ),
        gate(conservation(fanned, tier), "time conserved", F.count_if(~F.col("passed"))),
        gate_rows(
            levels.join(served, list(KEYS), "full_outer"),
            ("no level below zero", F.sum("below"), 0),
            ("peaks equal the sweep", F.count_if(~F.col("sweep").eqNullSafe(F.col("served"))), 0),
        ),
    ])


def publish(generation: int, attested: dict[str, str], recomputed: dict[str, str], gates: DataFrame, rows: DataFrame) -> DataFrame:
    """rows marked with the generation, if all gates pass and every attested hash is found again; else raises."""
    require(gates)
    wrong = sorted(k for k in attested.keys() | recomputed.keys() if attested.get(k) != recomputed.get(k))
    if wrong:
        raise RuntimeError(f"attestations do not match: {', '.join(wrong)}")
    return rows.withColumn("generation", F.lit(generation))
