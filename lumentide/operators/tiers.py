"""Materialised tiers: dense buckets per mask, the live rollup, the minute rollup, derived masks, generations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumentide.functions.scalars import bucket, grouping
from lumentide.operators.boundaries import KEYS, curve, spread, swept

ROLLUP_KEYS = ("rollup_mask", "content_id", "platform", "country", "app_version", "video_type", "category")


def dense_tier(fanned: DataFrame, points: DataFrame, size: int) -> DataFrame:
    """KEYS, bucket_ms, peak, active_ms, ending_concurrency, boundary_points of every bucket with activity.

    The peak is the highest level after a boundary inside, or the level carried in; ending counts
    intervals that reach over the bucket's end, one that starts on it too.
    """
    met = spread(fanned, size)
    end = F.col("bucket_ms") + size
    active = met.groupBy(*KEYS, "bucket_ms").agg(F.sum("overlap_ms").alias("active_ms"), F.count_if((F.col("start_ms") <= end) & (F.col("end_ms") > end)).alias("ending_concurrency"))
    swept = curve(points).groupBy(*KEYS, bucket(F.col("boundary_ms"), size).alias("bucket_ms")).agg(F.max("level").alias("top"), F.count("*").alias("boundary_points"))
    entering = F.coalesce(F.lag("ending_concurrency").over(Window.partitionBy(*KEYS).orderBy("bucket_ms")), F.lit(0))
    out = active.join(swept, [*KEYS, "bucket_ms"], "left").fillna(0, ["top", "boundary_points"])
    return out.withColumn("entering", entering).select(*KEYS, "bucket_ms", F.greatest("top", "entering").alias("peak"), "active_ms", "ending_concurrency", "boundary_points")


def _levels_with_anchors(parts: DataFrame, size: int, keys: tuple[str, ...]) -> DataFrame:
    """keys, at_ms, level: after each boundary, and at the begin of each bucket that a part overlaps, so that a level carried in is seen."""
    edges = F.explode(F.array(F.struct(F.col("start_ms").alias("at_ms"), F.lit(1).alias("d")), F.struct(F.col("end_ms").alias("at_ms"), F.lit(-1).alias("d")))).alias("e")
    ends = parts.select(*keys, edges).select(*keys, "e.*")
    begins = spread(parts, size).select(*keys, F.col("bucket_ms").alias("at_ms"), F.lit(0).alias("d"))
    net = ends.unionByName(begins).groupBy(*keys, "at_ms").agg(F.sum("d").alias("d"))
    return swept(net, F.col("d"), keys, "at_ms").select(*keys, "at_ms", "level")


def _peaks(levels: DataFrame, size: int, keys: tuple[str, ...]) -> DataFrame:
    return levels.groupBy(*keys, bucket(F.col("at_ms"), size).alias("bucket_ms")).agg(F.greatest(F.max("level"), F.lit(0)).alias("peak"), F.greatest(F.max_by("level", "at_ms"), F.lit(0)).alias("ending_concurrency"))


def live_rollup(fanned: DataFrame, low: int, high: int, size: int) -> DataFrame:
    """rollup_mask, content_id, bucket_ms, peak, ending_concurrency, active_ms over [low, high); the last level inside a bucket is its ending one."""
    keys = ("rollup_mask", "content_id")
    cut = fanned.where((F.col("start_ms") < high) & (F.col("end_ms") > low)).withColumns({"start_ms": F.greatest("start_ms", F.lit(low)), "end_ms": F.least("end_ms", F.lit(high))}).where("end_ms > start_ms")
    active = spread(cut, size).groupBy(*keys, "bucket_ms").agg(F.sum("overlap_ms").alias("active_ms"))
    out = _peaks(_levels_with_anchors(cut, size, keys), size, keys).join(active, [*keys, "bucket_ms"], "left").fillna(0, ["active_ms"])
    return out.where("peak > 0 or active_ms > 0")


def minute_rollup(fanned: DataFrame, size: int) -> DataFrame:
    """ROLLUP_KEYS, grouping, bucket_ms, peak, ending_concurrency, active_ms, sessions_active, sessions_started, sessions_ended.

    Activity, starts and ends are one aggregation of the spread rows: an interval starts in its
    first bucket and ends in its last.
    """
    met = spread(fanned, size)
    started = F.count_if(bucket(F.col("start_ms"), size) == F.col("bucket_ms"))
    ended = F.count_if(bucket(F.col("end_ms") - 1, size) == F.col("bucket_ms"))
    active = met.groupBy(*ROLLUP_KEYS, "bucket_ms").agg(F.sum("overlap_ms").alias("active_ms"), F.count_distinct("session_key").alias("sessions_active"), started.alias("sessions_started"), ended.alias("sessions_ended"))
    out = _peaks(_levels_with_anchors(fanned, size, ROLLUP_KEYS), size, ROLLUP_KEYS).join(active, [*ROLLUP_KEYS, "bucket_ms"], "left")
    out = out.fillna(0, ["active_ms", "sessions_active", "sessions_started", "sessions_ended"]).where("peak > 0 or active_ms > 0")
    return out.withColumn("grouping", grouping(F.col("rollup_mask")))


def overlap_counts(intervals: DataFrame, size: int) -> DataFrame:
    """bucket_ms, sessions (any overlap counts, islands of one session once), active_ms."""
    return spread(intervals, size).groupBy("bucket_ms").agg(F.count_distinct("session_key").alias("sessions"), F.sum("overlap_ms").alias("active_ms"))


def derived_mask(tier: DataFrame, contents: DataFrame, source: int = 5, mask: int = 13) -> DataFrame:
    """The tier of a mask with video_type from that without: the content determines its type."""
    kinds = contents.select("content_id", F.nullif("video_type", F.lit("")).alias("kind"))
    out = tier.where(F.col("rollup_mask") == source).join(kinds, "content_id", "left")
    return out.select(*[c for c in tier.columns if c not in ("rollup_mask", "video_type")], F.lit(mask).alias("rollup_mask"), F.coalesce("kind", F.lit("__unknown__")).alias("video_type"))


def current_generation(versions: DataFrame) -> DataFrame:
    """Rows of the newest generation."""
    newest = versions.agg(F.max("generation").alias("generation"))
    return versions.join(F.broadcast(newest), "generation", "left_semi")  # one row


def coarser(tier: DataFrame, size: int) -> DataFrame:
    """A tier in larger buckets: active time adds up, the peak is the highest (same mask), the last ending stays."""
    return tier.groupBy(*KEYS, bucket(F.col("bucket_ms"), size).alias("grain_ms")).agg(F.max("peak").alias("peak"), F.sum("active_ms").alias("active_ms"), F.max_by("ending_concurrency", "bucket_ms").alias("ending_concurrency"), F.count("*").alias("buckets"))


SQL = """, sp AS (
  SELECT *, unnest(generate_series(start_ms - start_ms % {size}, (end_ms - 1) - (end_ms - 1) % {size}, {size})) AS bucket_ms FROM fan
), tier AS (
  SELECT t.rollup_mask, t.platform, t.country, t.content_id, t.video_type, t.bucket_ms, greatest(coalesce(s.top, 0), coalesce(lag(t.ending_concurrency) OVER (PARTITION BY t.rollup_mask, t.platform, t.country, t.content_id, t.video_type ORDER BY t.bucket_ms), 0)) AS peak,
    t.active_ms, t.ending_concurrency, coalesce(s.n, 0) AS boundary_points
  FROM (SELECT rollup_mask, platform, country, content_id, video_type, bucket_ms, CAST(sum(least(end_ms, bucket_ms + {size}) - greatest(start_ms, bucket_ms)) AS BIGINT) AS active_ms,
      count(*) FILTER (start_ms <= bucket_ms + {size} AND end_ms > bucket_ms + {size}) AS ending_concurrency FROM sp GROUP BY ALL) t
  LEFT JOIN (SELECT rollup_mask, platform, country, content_id, video_type, boundary_ms - boundary_ms % {size} AS bucket_ms, max(level) AS top, count(*) AS n FROM cv GROUP BY ALL) s
    USING (rollup_mask, platform, country, content_id, video_type, bucket_ms)
)"""

#: The minute rollup in the oracle; {keys} are its key columns.
ROLLUP_SQL = """, ru AS (
  SELECT {keys}, bucket_ms, CAST(sum(least(end_ms, bucket_ms + {size}) - greatest(start_ms, bucket_ms)) AS BIGINT) AS active_ms, count(DISTINCT session_key) AS sessions_active,
    count(*) FILTER (start_ms >= bucket_ms) AS sessions_started, count(*) FILTER (end_ms <= bucket_ms + {size}) AS sessions_ended FROM sp GROUP BY ALL
), lv AS (
  SELECT {keys}, at_ms, CAST(sum(sum(d)) OVER (PARTITION BY {keys} ORDER BY at_ms ROWS UNBOUNDED PRECEDING) AS BIGINT) AS level FROM (
    SELECT {keys}, start_ms AS at_ms, 1 AS d FROM fan UNION ALL SELECT {keys}, end_ms, -1 FROM fan UNION ALL SELECT DISTINCT {keys}, bucket_ms, 0 FROM sp) GROUP BY {keys}, at_ms
), pk AS (
  SELECT {keys}, at_ms - at_ms % {size} AS bucket_ms, max(level) AS peak, arg_max(level, at_ms) AS ending_concurrency FROM lv GROUP BY ALL
), rollup AS (
  SELECT pk.*, coalesce(active_ms, 0) AS active_ms, coalesce(sessions_active, 0) AS sessions_active, coalesce(sessions_started, 0) AS sessions_started, coalesce(sessions_ended, 0) AS sessions_ended
  FROM pk LEFT JOIN ru USING ({keys}, bucket_ms) WHERE peak > 0 OR active_ms > 0
)"""
