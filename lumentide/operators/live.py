"""Live state, viewer drops, baselines to compare with, and one session's timeline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumentide.functions.scalars import bucket
from lumentide.operators.boundaries import spread


def live_state(events: DataFrame) -> DataFrame:
    """A row for each session, from mergeable aggregates: last event, ended, and the last setter on both axes.

    The batch twin of the streaming operator; stop wins among signals of one instant.
    """

    def last_setter(on: tuple[str, ...], off: tuple[str, ...]) -> Column:
        sets = F.col("signal").isin(*on, *off)
        stop = F.col("signal").isin(*off).cast("int")
        return F.coalesce(F.max_by(F.when(sets, 1 - stop), F.when(sets, F.struct("event_ms", stop.alias("stop")))), F.lit(0))

    first = F.min_by(F.struct("platform", "country", "content_id"), F.struct("event_ms", "row_version")).alias("first")
    out = events.groupBy("session_key").agg(
        F.max("event_ms").alias("last_event_ms"),
        F.bool_or(F.col("signal") == "session_end").alias("terminated"),
        last_setter(("session_start", "foreground", "play", "resume", "liveness"), ("background", "session_end")).alias("fg"),
        last_setter(("play", "resume"), ("pause", "error", "session_end")).alias("play"),
        first,
    )
    return out.select("session_key", "last_event_ms", "terminated", "fg", "play", "first.*")


def live_now(state: DataFrame, as_of: int, timeout_ms: int) -> DataFrame:
    """Sessions that count as live at as_of; expiry needs no timer, the reader filters."""
    return state.where((F.col("last_event_ms") > as_of - timeout_ms) & (F.col("last_event_ms") <= as_of) & ~F.col("terminated"))


def live_counts(live: DataFrame, *by: str) -> DataFrame:
    return live.groupBy(*by).agg(F.count_if((F.col("fg") == 1) & (F.col("play") == 1)).alias("live_viewers"), F.count_if(F.col("fg") == 1).alias("live_incl_paused"))


def lease_state(intervals: DataFrame, events: DataFrame, observed: int) -> DataFrame:
    """Per session: when its lease ends, whether it is active at the horizon, whether it has ended, its last start."""
    ended = events.where("signal = 'session_end'").select("session_key").distinct().withColumn("terminated", F.lit(True))
    per = intervals.groupBy("session_key").agg(F.max("end_ms").alias("lease_expiry_ms"), F.max("start_ms").alias("open_start_ms"))
    return per.join(ended, "session_key", "left").select("session_key", "lease_expiry_ms", (F.col("lease_expiry_ms") > observed).alias("is_active_now"), F.coalesce("terminated", F.lit(False)).alias("is_terminated"), "open_start_ms")


def drop_signal(observed: DataFrame, low: int, high: int, size: int, baseline_buckets: int = 15, min_baseline: float = 25.0, persist: int = 2, settled_until: int | None = None) -> DataFrame:
    """Per slice and bucket: viewers against the median of the buckets before, and how far they have been retained.

    observed: slice, bucket_ms, active_ms, peak.  Every slice has every bucket; retention is at
    most 1, is 1 where the baseline is too small for an opinion, and ``retention_sustained`` is
    the best of the last buckets, so that it is low only if all of them are.
    """
    start = low - baseline_buckets * size
    here = observed.where((F.col("bucket_ms") >= start) & (F.col("bucket_ms") < high))
    seen = here.groupBy("slice", "bucket_ms").agg((F.sum("active_ms") / float(size)).alias("observed"), F.max("peak").alias("peak"))
    grid = here.select("slice").distinct().withColumn("bucket_ms", F.explode(F.sequence(F.lit(start).cast("long"), F.lit(high - size).cast("long"), F.lit(size).cast("long"))))
    dense = grid.join(seen, ["slice", "bucket_ms"], "left").fillna(0, ["observed", "peak"])
    order = Window.partitionBy("slice").orderBy("bucket_ms")
    scored = dense.withColumn("raw", F.percentile("observed", F.lit(0.5)).over(order.rowsBetween(-baseline_buckets, -1)))
    opinion = F.coalesce(F.col("raw") >= min_baseline, F.lit(False))
    out = scored.select(
        "slice", "bucket_ms", F.round("observed", 6).alias("observed"), "peak", F.round(F.coalesce("raw", F.lit(0.0)), 6).alias("baseline"), opinion.alias("has_opinion"),
        F.when(opinion, F.least(F.lit(1.0), F.round(F.col("observed") / F.col("raw"), 6))).otherwise(1.0).alias("retention"),
    ).where(F.col("bucket_ms") >= low)
    out = out.withColumn("drop_pct", F.round(100.0 * (1.0 - F.col("retention")), 3))
    out = out.withColumn("retention_sustained", F.max("retention").over(order.rowsBetween(-persist, 0)))
    return out.withColumn("is_settled", F.lit(True) if settled_until is None else F.col("bucket_ms") < settled_until)


def breaches(signal: DataFrame, below: float = 0.7) -> DataFrame:
    return signal.where(F.col("has_opinion") & F.col("is_settled") & (F.col("retention_sustained") < below))


def heartbeat_cover(events: DataFrame, timeout_ms: int, size: int) -> DataFrame:
    """bucket_ms, session_key: bucket starts that a liveness event covers for the timeout after it, whatever the state."""
    up = F.col("event_ms") + F.pmod(-F.col("event_ms"), F.lit(size))
    last = bucket(F.col("event_ms") + timeout_ms - 1, size)
    lively = events.where(F.col("signal").isin("play", "liveness", "resume")).where(up <= last)
    return lively.select("session_key", F.explode(F.sequence(up, last, F.lit(size).cast("long"))).alias("bucket_ms")).distinct()


def span_intervals(events: DataFrame) -> DataFrame:
    """Every session as active from its first event to its last: the naive count."""
    return events.groupBy("session_key").agg(F.min("event_ms").alias("start_ms"), F.max("event_ms").alias("end_ms")).where("end_ms > start_ms")


def minute_ground_truth(events: DataFrame, size: int) -> DataFrame:
    """bucket_ms, sessions by an independent rule: buckets covered by activity, less those wholly inside a background or a pause."""
    e = events.withColumn("b", bucket(F.col("event_ms"), size))
    own = e.groupBy("session_key").agg(F.min("b").alias("b_first"), F.max("b").alias("b_last"))
    active = e.where(F.col("event_type").isin("VideoSessionStart", "VideoPlay", "VideoHeartbeat", "AppForegrounded"))
    cover = active.select("session_key", F.explode(F.array(*[F.col("b") + k * size for k in range(3)])).alias("bucket_ms")).distinct()
    cover = cover.join(own, "session_key").where("bucket_ms between b_first and b_last").select("session_key", "bucket_ms")

    def excluded(kinds: Column, opens: Column, closes: Column) -> DataFrame:
        ahead = Window.partitionBy("session_key").orderBy("event_ms", "row_version").rowsBetween(1, Window.unboundedFollowing)
        w = e.where(kinds).select("session_key", "event_ms", opens.alias("opens"), F.min(F.when(closes, F.col("event_ms"))).over(ahead).alias("until"))
        w = w.where("opens").join(own, "session_key")
        low = F.greatest(F.col("event_ms") + F.pmod(-F.col("event_ms"), F.lit(size)), "b_first")
        high = F.coalesce(F.least(bucket(F.col("until"), size) - size, "b_last"), "b_last")
        w = w.select("session_key", low.alias("low"), high.alias("high")).where("low <= high")
        return w.select("session_key", F.explode(F.sequence("low", "high", F.lit(size).cast("long"))).alias("bucket_ms")).distinct()

    kind, sig = F.col("event_type"), F.col("signal")
    hidden = excluded(kind.isin("AppBackgrounded", "AppForegrounded"), kind == "AppBackgrounded", kind == "AppForegrounded")
    paused = excluded(sig.isin("pause", "error", "play", "resume"), sig.isin("pause", "error"), sig.isin("play", "resume"))
    left = cover.join(hidden, ["session_key", "bucket_ms"], "left_anti").join(paused, ["session_key", "bucket_ms"], "left_anti")
    return left.groupBy("bucket_ms").agg(F.count("*").alias("sessions"))


def runs_of_buckets(events: DataFrame, size: int) -> DataFrame:
    """session_key, runs: maximal runs of neighbouring buckets with events, by array functions on one row of each session."""
    b = F.sort_array(F.collect_set(bucket(F.col("event_ms"), size)))
    per = events.groupBy("session_key").agg(b.alias("b"))
    first = F.filter("b", lambda x, i: (i == 0) | (F.get(F.col("b"), i - 1) < x - size))
    last = F.filter("b", lambda x, i: (i == F.size("b") - 1) | (F.get(F.col("b"), i + 1) > x + size))
    return per.select("session_key", F.zip_with(first, last, lambda x, y: F.struct(x.alias("start_ms"), (y + size).alias("end_ms"))).alias("runs"))


def timeline(leased: DataFrame, clipped: DataFrame) -> DataFrame:
    """Per instant of each session: its signals by name, the state after it, the lease."""
    names = clipped.groupBy("session_key", "event_ms").agg(F.array_join(F.sort_array(F.collect_set("signal")), "+").alias("signals"))
    return leased.join(names, ["session_key", "event_ms"]).select("session_key", "event_ms", "signals", F.col("fg_state").cast("int").alias("fg_state"), F.col("play_state").cast("int").alias("play_state"), "started", "ended", "on", "last_eligible", "next_ms")


def liveness_curve(events: DataFrame, size: int) -> DataFrame:
    return events.groupBy(bucket(F.col("event_ms"), size).alias("bucket_ms")).agg(F.count_distinct("session_key").alias("sessions"), F.count("*").alias("events"))


def dense_curve(intervals: DataFrame, low: int, high: int, size: int) -> DataFrame:
    """bucket_ms, sessions of every bucket of [low, high): sessions, not intervals, and zeros too."""
    met = spread(intervals, size).groupBy("bucket_ms").agg(F.count_distinct("session_key").alias("sessions"))
    spine = intervals.sparkSession.range(low - low % size, high, size).select(F.col("id").alias("bucket_ms"))
    return spine.join(met, "bucket_ms", "left").fillna(0, ["sessions"])
