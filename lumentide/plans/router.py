"""Which materialised rollup answers a question, and panels over it.

A peak is exact only on the rollup whose dimensions are those filtered or broken down by; on any
other it is withheld.  Active time adds up, so it is exact on any finer rollup.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumentide.operators.boundaries import bucket_metrics
from lumentide.policy import BITS, GROUPINGS, TIER_MASKS


@dataclass(frozen=True)
class Choice:
    mask: int
    exact_peak: bool
    why: str


def remap(mask: int) -> int:
    """Content determines its video type, so content with video type reads the rollup without."""
    return mask & ~8 if mask in (12, 13) else mask


def choose(dims: set[str], masks: tuple[int, ...] = TIER_MASKS) -> Choice:
    """The rollup for a question over dims."""
    unknown = dims - BITS.keys()
    if unknown:
        raise ValueError(f"no such dimension: {', '.join(sorted(unknown))}")
    wanted = sum(BITS[d] for d in dims)
    if remap(wanted) in masks:
        return Choice(remap(wanted), True, f"materialised as {GROUPINGS[remap(wanted)]}")
    finer = [m for m in masks if m & wanted == wanted]
    if not finer:
        raise ValueError(f"no rollup holds {', '.join(sorted(dims))}")
    best = min(finer, key=lambda m: (m.bit_count(), m))
    return Choice(best, False, f"no rollup at this combination; the time is exact from {GROUPINGS[best]}, the peak is withheld")


def optional(filters: dict[str, object]) -> Column:
    """All filters that are set; an empty value, 0 or "*" filters nothing."""
    out = F.lit(True)
    for dim, value in filters.items():
        if value not in (None, "", 0, "*"):
            out = out & (F.col(dim) == value)
    return out


def panel(tier: DataFrame, low: int, high: int, by: tuple[str, ...] = (), filters: dict[str, object] | None = None, size: int | None = None) -> DataFrame:
    """by, active_ms, hours, avg_concurrency and peak (null where it is withheld) over [low, high)."""
    held = {d: v for d, v in (filters or {}).items() if v not in (None, "", 0, "*")}
    dims = {b for b in by if b != "bucket_ms"} | set(held)
    choice = choose(dims)
    if "video_type" in dims and remap(sum(BITS[d] for d in dims)) != sum(BITS[d] for d in dims):
        raise ValueError("video_type goes with content_id; look it up")
    rows = tier.where((F.col("rollup_mask") == choice.mask) & (F.col("bucket_ms") >= low) & (F.col("bucket_ms") < high)).where(optional(held))
    peak = F.max("peak") if choice.exact_peak else F.lit(None).cast("long")
    out = rows.groupBy(*by).agg(F.coalesce(F.sum("active_ms"), F.lit(0)).alias("active_ms"), peak.alias("peak"))
    length = size if "bucket_ms" in by and size else max(high - low, 1)
    return out.select(*by, "active_ms", F.round(F.col("active_ms") / 3_600_000, 6).alias("hours"), F.round(F.col("active_ms") / length, 6).alias("avg_concurrency"), "peak")


def kpi(rows: DataFrame, low: int, high: int) -> DataFrame:
    """One row over a curve (bucket_ms, peak, active_ms)."""
    return rows.agg(
        F.coalesce(F.max("peak"), F.lit(0)).alias("peak"), F.min_by("bucket_ms", F.struct(-F.col("peak"), "bucket_ms")).alias("peak_bucket_ms"), F.round(F.coalesce(F.sum("active_ms"), F.lit(0)) / max(high - low, 1), 6).alias("avg_concurrency"),
        F.round(F.coalesce(F.sum("active_ms"), F.lit(0)) / 3_600_000, 6).alias("viewing_hours"), F.count("*").alias("buckets"), F.min("bucket_ms").alias("first_ms"), F.max("bucket_ms").alias("last_ms"),
    )


def served_range(tier: DataFrame, points: DataFrame, low: int, high: int, size: int, exact: bool = False) -> DataFrame:
    """route, peak, avg_concurrency over [low, high): from the total's tier if the range is of whole buckets, else from the total's boundaries."""
    if exact or low % size or high % size:
        route, rows = "exact", bucket_metrics(points, low, high, size)
    else:
        route, rows = "tier", tier.where((F.col("bucket_ms") >= low) & (F.col("bucket_ms") < high))
    out = rows.agg(F.coalesce(F.max("peak"), F.lit(0)).alias("peak"), F.round(F.coalesce(F.sum("active_ms"), F.lit(0)) / max(high - low, 1), 6).alias("avg_concurrency"))
    return out.select(F.lit(route).alias("route"), "peak", "avg_concurrency")


def filter_support(spark: SparkSession, masks: tuple[int, ...] = TIER_MASKS) -> DataFrame:
    """For each combination of the four filters: the rollup that serves it, and whether there is one."""
    m = F.col("id").cast("int")
    served = F.when(m == 12, 4).when(m == 13, 5).otherwise(m)
    return spark.range(16).select(m.alias("requested_mask"), *[(m.bitwiseAND(BITS[d]) == BITS[d]).alias(f"filters_{d}") for d in ("platform", "country", "content_id", "video_type")], served.alias("served_by_mask"), served.isin(*masks).alias("supported"))


def filter_options(tier: DataFrame) -> DataFrame:
    """dimension, value, active_ms of every value that a single-dimension rollup has."""
    parts = [tier.where(F.col("rollup_mask") == BITS[d]).select(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value"), "active_ms") for d in ("platform", "country", "video_type")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("dimension", "value").agg(F.sum("active_ms").alias("active_ms"))


def top_and_other(rows: DataFrame, member: str, by: str, n: int, *keep: str) -> DataFrame:
    """Sums of ``by`` with members beyond the n largest folded into "other"."""
    top = rows.groupBy(member).agg(F.sum(by).alias("total")).orderBy(F.col("total").desc(), member).limit(n).select(member, F.lit(True).alias("top"))
    named = rows.join(top, member, "left").withColumn("member", F.when(F.col("top"), F.col(member).cast("string")).otherwise("other"))
    return named.groupBy("member", *keep).agg(F.sum(by).alias(by))


def shares(rows: DataFrame, member: str, by: str) -> DataFrame:
    per = rows.groupBy(member).agg(F.sum(by).alias(by))
    return per.withColumn("share_pct", F.round(100.0 * F.col(by) / F.nullif(F.sum(by).over(Window.partitionBy()), F.lit(0)), 6))


def search(contents: DataFrame, text: str, limit: int) -> DataFrame:
    """Titles or categories that contain the text in any case, the shortest titles first."""
    hit = F.contains(F.lower("title"), F.lit(text.lower())) | F.contains(F.lower("category"), F.lit(text.lower()))
    return contents.where(hit).orderBy(F.length("title"), "content_id").limit(limit)


def page(rows: DataFrame, order: tuple[Column | str, ...], limit: int, offset: int = 0) -> DataFrame:
    return rows.orderBy(*order).offset(offset).limit(limit)
