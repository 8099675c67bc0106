"""Signed boundaries of intervals, the level curve, and exact answers from them.

A curve is a running sum over all time.  It is taken in two levels: net changes of whole hours
give each hour's entering level, and inside an hour a window runs on its own, so that even the
total curve, which has one key, is spread over hours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumentide.functions.scalars import bucket, masked
from lumentide.policy import DAY, HOUR

KEYS = ("rollup_mask", "platform", "country", "content_id", "video_type")
#: A running sum is one task for each key and slot of time.
SLOT = HOUR


def fan_out(intervals: DataFrame, masks: tuple[int, ...], *more: str) -> DataFrame:
    """A copy of each interval for each mask, with the dimensions that the mask clears set to "all"."""
    out = intervals.withColumn("rollup_mask", F.explode(F.array(*map(F.lit, masks))))
    cleared = {"content_id": 0}
    dims = [d for d in ("platform", "country", "content_id", "video_type", *more)]
    return out.withColumns({d: masked(F.col("rollup_mask"), d, cleared.get(d, "")) for d in dims})


def deltas(fanned: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """keys, boundary_ms, opens, closes: summed, so that a key has one row for each instant."""
    ends = F.explode(F.array(F.struct(F.col("start_ms").alias("boundary_ms"), F.lit(1).alias("opens"), F.lit(0).alias("closes")), F.struct(F.col("end_ms").alias("boundary_ms"), F.lit(0).alias("opens"), F.lit(1).alias("closes"))))
    rows = fanned.select(*keys, ends.alias("b"))
    return rows.groupBy(*keys, F.col("b.boundary_ms").alias("boundary_ms")).agg(F.sum("b.opens").alias("opens"), F.sum("b.closes").alias("closes"))


def bucket_net(points: DataFrame, size: int, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Checkpoints of each bucket; n_deltas keeps those whose changes cancel."""
    return points.groupBy(*keys, bucket(F.col("boundary_ms"), size).alias("bucket_ms")).agg(F.sum("opens").alias("opens"), F.sum("closes").alias("closes"), F.count("*").alias("n_deltas"))


def day_anchors(points: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """keys, day_ms, level: the level at each midnight of the days that have a boundary, and at the one after the last."""
    days = points.groupBy(*keys, bucket(F.col("boundary_ms"), DAY).alias("day_ms")).agg(F.sum(F.col("opens") - F.col("closes")).alias("net"))
    spine = days.groupBy(*keys).agg(F.min("day_ms").alias("low"), F.max("day_ms").alias("high")).select(*keys, F.explode(F.sequence("low", F.col("high") + DAY, F.lit(DAY).cast("long"))).alias("day_ms"))
    before = Window.partitionBy(*keys).orderBy("day_ms").rowsBetween(Window.unboundedPreceding, -1)
    return spine.join(days, [*keys, "day_ms"], "left").select(*keys, "day_ms", F.coalesce(F.sum("net").over(before), F.lit(0)).alias("level"))


def swept(points: DataFrame, change: Column, keys: tuple[str, ...] = KEYS, at: str = "boundary_ms") -> DataFrame:
    """points with level, the sum of ``change`` up to them, and next, the instant after theirs (null: none); instants are distinct.

    Windows run inside a slot; what enters a slot and what follows it is told by one row of each slot of the key.
    """
    rows = points.withColumn("slot", bucket(F.col(at), SLOT)).withColumn("change", change)
    slots = rows.groupBy(*keys, "slot").agg(F.sum("change").alias("net"), F.min(at).alias("first"))
    over = Window.partitionBy(*keys).orderBy("slot")
    around = slots.select(*keys, "slot", F.coalesce(F.sum("net").over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("entering"), F.lead("first").over(over).alias("following"))
    inside = Window.partitionBy(*keys, "slot").orderBy(at)
    ran = F.sum("change").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.select(*points.columns, "slot", ran.alias("ran"), F.lead(at).over(inside).alias("after")).join(around, [*keys, "slot"])
    return rows.select(*points.columns, (F.col("entering") + F.col("ran")).alias("level"), F.coalesce("after", "following").alias("next"))


def curve(points: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """keys, boundary_ms, level after it."""
    return swept(points, F.col("opens") - F.col("closes"), keys).select(*keys, "boundary_ms", "level")


def peak(levels: DataFrame, *by: str) -> DataFrame:
    """peak and the first instant at which it is reached."""
    return levels.groupBy(*by).agg(F.max("level").alias("peak"), F.min_by("boundary_ms", F.struct(-F.col("level"), "boundary_ms")).alias("peak_ms"))


def steps(points: DataFrame, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """keys, start_ms, end_ms, level: from each boundary to the next."""
    return swept(points, F.col("opens") - F.col("closes"), keys).where("next is not null").select(*keys, F.col("boundary_ms").alias("start_ms"), F.col("next").alias("end_ms"), "level")


def window_peak(points: DataFrame, anchors: DataFrame, low: int, high: int, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """keys, peak in [low, high): the day's anchor, what changed until low, and the highest prefix inside; nothing before that day is read."""
    day = low - low % DAY
    start = anchors.where(F.col("day_ms") == day).select(*keys, F.col("level").alias("anchor"))
    near = points.where((F.col("boundary_ms") >= day) & (F.col("boundary_ms") < high)).withColumn("d", F.col("opens") - F.col("closes"))
    until = near.where(F.col("boundary_ms") <= low).groupBy(*keys).agg(F.sum("d").alias("until"))
    inside = near.where(F.col("boundary_ms") > low)
    top = curve(inside, keys).groupBy(*keys).agg(F.max("level").alias("top"))
    every = start.select(*keys).unionByName(until.select(*keys)).unionByName(top.select(*keys)).distinct()
    out = every.join(start, list(keys), "left").join(until, list(keys), "left").join(top, list(keys), "left").fillna(0, ["anchor", "until"])
    return out.select(*keys, (F.col("anchor") + F.col("until") + F.greatest(F.coalesce("top", F.lit(0)), F.lit(0))).alias("peak"))


def overlap(low: Column, high: Column) -> Column:
    return F.greatest(F.least("end_ms", high) - F.greatest("start_ms", low), F.lit(0))


def average(intervals: DataFrame, low: int, high: int) -> DataFrame:
    """active_ms in [low, high) and the time-weighted average level."""
    cut = intervals.where((F.col("start_ms") < high) & (F.col("end_ms") > low))
    total = F.coalesce(F.sum(overlap(F.lit(low), F.lit(high))), F.lit(0))
    return cut.agg(total.alias("active_ms")).select("active_ms", F.round(F.col("active_ms") / max(high - low, 1), 6).alias("avg_concurrency"))


def spread(parts: DataFrame, size: int) -> DataFrame:
    """A row of each part [start_ms, end_ms) for each bucket that it overlaps, with bucket_ms and overlap_ms."""
    first, last = bucket(F.col("start_ms"), size), bucket(F.col("end_ms") - 1, size)
    rows = parts.where("end_ms > start_ms").withColumn("bucket_ms", F.explode(F.sequence(first, last, F.lit(size).cast("long"))))
    return rows.withColumn("overlap_ms", overlap(F.col("bucket_ms"), F.col("bucket_ms") + size))


def bucket_metrics(points: DataFrame, low: int, high: int, size: int) -> DataFrame:
    """bucket_ms, peak, active_ms, avg of every bucket of [low, high) of the total's points, empty ones too; edge buckets are averaged over the part inside."""
    parts = steps(points, ("rollup_mask",)).where((F.col("level") > 0) & (F.col("start_ms") < high) & (F.col("end_ms") > low)).select(F.greatest("start_ms", F.lit(low)).alias("start_ms"), F.least("end_ms", F.lit(high)).alias("end_ms"), "level")
    met = spread(parts, size).groupBy("bucket_ms").agg(F.max("level").alias("peak"), F.sum(F.col("level") * F.col("overlap_ms")).alias("active_ms"))
    spine = points.sparkSession.range(low - low % size, high, size).select(F.col("id").alias("bucket_ms"))
    length = F.least(F.col("bucket_ms") + size, F.lit(high)) - F.greatest("bucket_ms", F.lit(low))
    out = spine.join(met, "bucket_ms", "left").fillna(0, ["peak", "active_ms"])
    return out.withColumn("avg_concurrency", F.round(F.col("active_ms") / length, 6))


SQL = """, m AS (
  SELECT unnest({masks}) AS rollup_mask
), fan AS (
  SELECT m.rollup_mask, CASE WHEN rollup_mask & 1 > 0 THEN platform ELSE '' END AS platform, CASE WHEN rollup_mask & 2 > 0 THEN country ELSE '' END AS country,
    CASE WHEN rollup_mask & 4 > 0 THEN content_id ELSE 0 END AS content_id, CASE WHEN rollup_mask & 8 > 0 THEN video_type ELSE '' END AS video_type,
    CASE WHEN rollup_mask & 16 > 0 THEN app_version ELSE '' END AS app_version, CASE WHEN rollup_mask & 32 > 0 THEN category ELSE '' END AS category,
    session_key, user_key, start_ms, end_ms FROM iv, m
), dl AS (
  SELECT rollup_mask, platform, country, content_id, video_type, boundary_ms, CAST(sum(o) AS BIGINT) AS opens, CAST(sum(c) AS BIGINT) AS closes FROM (
    SELECT *, start_ms AS boundary_ms, 1 AS o, 0 AS c FROM fan UNION ALL SELECT *, end_ms, 0, 1 FROM fan) GROUP BY ALL
), cv AS (
  SELECT *, CAST(sum(opens - closes) OVER (PARTITION BY rollup_mask, platform, country, content_id, video_type ORDER BY boundary_ms ROWS UNBOUNDED PRECEDING) AS BIGINT) AS level FROM dl
)"""
