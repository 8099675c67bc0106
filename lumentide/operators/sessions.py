"""From events to active intervals.

A session is active while it has started and not ended, is in the foreground, is playing, and
its last eligible signal is less than the timeout ago.  Everything is keyed by session, so one
shuffle by session_key serves the anchors, the state fold, the lease and the islands.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumentide.functions.scalars import LIVENESS
from lumentide.policy import Policy

DIMS = ("user_key", "content_id", "platform", "country", "app_version")
EVENT_KEY = ("session_key", "event_ms", "event_type", "event")


def dedup_latest(events: DataFrame) -> DataFrame:
    """One row of each (session, instant, type, name): the newest, of equal versions one by its values; with the number of copies."""
    rest = [c for c in events.columns if c not in EVENT_KEY]
    newest = F.max_by(F.struct(*rest), F.struct("row_version", F.xxhash64(*rest))).alias("newest")
    return events.groupBy(*EVENT_KEY).agg(newest, F.count("*").alias("copies")).select(*EVENT_KEY, "newest.*", "copies")


def horizon(events: DataFrame) -> int:
    """The last observed instant; 0 without events."""
    return events.agg(F.max("event_ms")).first()[0] or 0


def _has(*signals: str) -> Column:
    return F.col("signal").isin(*signals)


def anchors(events: DataFrame) -> DataFrame:
    """A row for each session: where it starts and ends, which signals it ever has, and its dimensions.

    The dimensions are those of its first start event, or of its first event.
    """
    starts = _has("session_start")
    first = F.min_by(F.struct(*DIMS), F.struct(~starts, "event_ms", "row_version")).alias("d")
    out = events.groupBy("session_key").agg(
        F.min(F.when(starts, F.col("event_ms"))).alias("first_start"),
        F.min("event_ms").alias("first_event"),
        F.max("event_ms").alias("last_event"),
        F.min(F.when(_has("session_end"), F.col("event_ms"))).alias("terminal_end"),
        F.bool_or(_has("play", "resume")).alias("has_play_signal"),
        F.bool_or(_has("session_start", "foreground")).alias("has_fg_signal"),
        first,
    )
    return out.select("session_key", F.coalesce("first_start", "first_event").alias("lifecycle_start"), F.col("first_start").isNotNull().alias("has_start"), "first_event", "last_event", "terminal_end", "has_play_signal", "has_fg_signal", "d.*")


def clipped_events(events: DataFrame, policy: Policy, as_of: int | None = None) -> DataFrame:
    """Events within their session's life, each with its session's anchor as a struct.

    The anchors are window aggregates over the session's own rows, so they need no join.
    """
    own = Window.partitionBy("session_key")
    starts = _has("session_start")
    e = events if as_of is None else events.where(F.col("event_ms") <= as_of)
    e = e.select(
        "*",
        F.min(F.when(starts, F.col("event_ms"))).over(own).alias("first_start"),
        F.min("event_ms").over(own).alias("first_event"),
        F.min(F.when(_has("session_end"), F.col("event_ms"))).over(own).alias("terminal_end"),
        F.max(_has("play", "resume")).over(own).alias("has_play_signal"),
        F.max(_has("session_start", "foreground")).over(own).alias("has_fg_signal"),
        F.min(F.struct((~starts).alias("later"), "event_ms", "row_version", *DIMS)).over(own).alias("first"),
    )
    begin = F.coalesce("first_start", "first_event")
    inside = (F.col("event_ms") >= begin) & (F.col("terminal_end").isNull() | (F.col("event_ms") <= F.col("terminal_end")))
    if policy.drop_later_starts:
        inside = inside & (~starts | (F.col("event_ms") == begin))
    if not policy.include_boundary_sessions:
        inside = inside & F.col("first_start").isNotNull()
    return e.where(inside).withColumn("has_start", F.col("first_start").isNotNull()).withColumn("lifecycle_start", begin)


def instants(clipped: DataFrame) -> DataFrame:
    """One row of each (session, instant): which kinds of signal it holds."""
    kept = ("lifecycle_start", "has_start", "has_play_signal", "has_fg_signal", "first")
    return clipped.groupBy("session_key", "event_ms").agg(
        *[F.any_value(c).alias(c) for c in kept],
        F.bool_or(_has("session_start")).alias("starts"),
        F.bool_or(_has("session_end")).alias("ends"),
        F.bool_or(_has("background")).alias("hides"),
        F.bool_or(_has("foreground")).alias("shows"),
        F.bool_or(_has("error", "pause")).alias("stops"),
        F.bool_or(_has("play", "resume")).alias("plays"),
        F.bool_or(_has(*LIVENESS)).alias("lives"),
    )


def state_fold(at: DataFrame) -> DataFrame:
    """Adds what each instant sets on the two axes (-1, 0, 1; stop wins) and the state after it."""
    past = Window.partitionBy("session_key").orderBy("event_ms").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fg = F.when(F.col("ends") | F.col("hides"), -1).when(F.col("starts") | F.col("shows"), 1).when(~F.col("has_fg_signal") & F.col("lives"), 1).otherwise(0)
    play = F.when(F.col("ends") | F.col("stops"), -1).when(F.col("plays"), 1).when(~F.col("has_play_signal") & F.col("lives"), 1).otherwise(0)
    at = at.withColumn("fg_setter", fg).withColumn("play_setter", play)
    held = lambda c: F.coalesce(F.last(F.nullif(F.col(c), F.lit(0)), ignorenulls=True).over(past), F.lit(0))
    return at.select(
        "*",
        (~F.col("has_start") | F.max("starts").over(past)).alias("started"),
        F.max("ends").over(past).alias("ended"),
        held("fg_setter").alias("fg_state"),
        held("play_setter").alias("play_state"),
    )


def lease(folded: DataFrame, policy: Policy, as_of: int) -> DataFrame:
    """Adds whether the state is on, the last eligible signal, and the next instant."""
    own = Window.partitionBy("session_key").orderBy("event_ms")
    past = own.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    on = F.col("started") & ~F.col("ended") & (F.col("fg_state") == 1) & (F.col("play_state") == 1)
    out = folded.withColumn("on", on).withColumn("eligible", on & F.col("lives"))
    return out.select("*", F.max(F.when(F.col("eligible"), F.col("event_ms"))).over(past).alias("last_eligible"), F.coalesce(F.lead("event_ms").over(own), F.lit(as_of + policy.timeout_ms)).alias("next_ms"))


def segments(leased: DataFrame, policy: Policy) -> DataFrame:
    """[start_ms, end_ms) from each instant at which the session is active."""
    end = F.least("next_ms", F.col("last_eligible") + policy.timeout_ms)
    active = F.col("on") & (F.col("event_ms") < F.col("last_eligible") + policy.timeout_ms) & (end > F.col("event_ms"))
    return leased.where(active).select("session_key", F.col("event_ms").alias("start_ms"), end.alias("end_ms"), "lifecycle_start", *[F.col(f"first.{d}").alias(d) for d in DIMS])


def islands(parts: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Adds the number of the island that each [start_ms, end_ms) belongs to; parts that touch are one island."""
    order = Window.partitionBy(*keys).orderBy("start_ms", "end_ms")
    before = F.max("end_ms").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = parts.withColumn("opens", (before.isNull() | (F.col("start_ms") > before)).cast("int"))
    return marked.withColumn("interval_index", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("long")).drop("opens")


def active_segments(events: DataFrame, policy: Policy, as_of: int | None = None) -> DataFrame:
    cut = horizon(events) + policy.timeout_ms if as_of is None else as_of
    return segments(lease(state_fold(instants(clipped_events(events, policy, cut))), policy, cut), policy)


def active_intervals(events: DataFrame, policy: Policy, as_of: int | None = None) -> DataFrame:
    """session_key, interval_index, start_ms, end_ms, lifecycle_start and the session's dimensions."""
    merged = islands(active_segments(events, policy, as_of), ("session_key",))
    kept = ("lifecycle_start", *DIMS)
    return merged.groupBy("session_key", "interval_index").agg(F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms"), *[F.any_value(c).alias(c) for c in kept])


def with_content(intervals: DataFrame, contents: DataFrame) -> DataFrame:
    """Adds video_type and category from the catalogue; what it does not know is ``__unknown__``."""
    known = contents.select("content_id", F.nullif("video_type", F.lit("")).alias("video_type"), F.nullif("category", F.lit("")).alias("category"))
    return intervals.join(known, "content_id", "left").fillna("__unknown__", ["video_type", "category"])


def clip_variants(intervals: DataFrame, observed: int) -> DataFrame:
    """Each interval as it is and cut at the observation horizon."""
    variants = F.explode(F.array(F.lit("unclipped"), F.lit("clipped"))).alias("clip_variant")
    out = intervals.select("*", variants)
    return out.withColumn("end_ms", F.when(F.col("clip_variant") == "clipped", F.least("end_ms", F.lit(observed))).otherwise(F.col("end_ms"))).where("end_ms > start_ms")


def interval_arrays(events: DataFrame, intervals: DataFrame) -> DataFrame:
    """One row of each session, with the sorted list of its intervals; sessions without any stay."""
    lists = intervals.groupBy("session_key").agg(F.array_sort(F.collect_list(F.struct("start_ms", "end_ms"))).alias("intervals"))
    every = events.select("session_key").distinct()
    none = F.array().cast("array<struct<start_ms:bigint,end_ms:bigint>>")
    return every.join(lists, "session_key", "left").withColumn("intervals", F.coalesce("intervals", none))


def current_revision(versions: DataFrame) -> DataFrame:
    """Rows of each session's newest state_revision; a session's tombstone (no start) leaves none."""
    newest = F.max("state_revision").over(Window.partitionBy("session_key"))
    return versions.withColumn("newest", newest).where("state_revision = newest and start_ms is not null").drop("newest")


#: Oracle chain after the binding's, for a timeout in {timeout}: anchors to intervals.
SQL = """, hz AS (
  SELECT max(event_ms) AS h, max(event_ms) + {timeout} AS as_of FROM dd
), an AS (
  SELECT session_key, min(event_ms) FILTER (signal = 'session_start') AS first_start, min(event_ms) AS first_event, max(event_ms) AS last_event,
    min(event_ms) FILTER (signal = 'session_end') AS terminal_end, count(*) FILTER (signal IN ('play', 'resume')) > 0 AS has_play_signal,
    count(*) FILTER (signal IN ('session_start', 'foreground')) > 0 AS has_fg_signal FROM dd GROUP BY session_key
), fd AS (
  SELECT session_key, user_key, content_id, platform, country, app_version FROM dd
  QUALIFY row_number() OVER (PARTITION BY session_key ORDER BY CASE WHEN signal = 'session_start' THEN 0 ELSE 1 END, event_ms, row_version) = 1
), ins AS (
  SELECT d.session_key, d.event_ms, any_value(coalesce(a.first_start, a.first_event)) AS lifecycle_start, any_value(a.first_start IS NOT NULL) AS has_start,
    bool_or(a.has_play_signal) AS has_play_signal, bool_or(a.has_fg_signal) AS has_fg_signal,
    bool_or(signal = 'session_start') AS starts, bool_or(signal = 'session_end') AS ends, bool_or(signal = 'background') AS hides, bool_or(signal = 'foreground') AS shows,
    bool_or(signal IN ('error', 'pause')) AS stops, bool_or(signal IN ('play', 'resume')) AS plays, bool_or(signal IN ('play', 'resume', 'liveness')) AS lives
  FROM dd d JOIN an a USING (session_key)
  WHERE d.event_ms >= coalesce(a.first_start, a.first_event) AND (a.terminal_end IS NULL OR d.event_ms <= a.terminal_end)
    AND (signal <> 'session_start' OR d.event_ms = coalesce(a.first_start, a.first_event))
  GROUP BY d.session_key, d.event_ms
), st0 AS (
  SELECT *, CASE WHEN ends OR hides THEN -1 WHEN starts OR shows THEN 1 WHEN NOT has_fg_signal AND lives THEN 1 ELSE 0 END AS fg_setter,
    CASE WHEN ends OR stops THEN -1 WHEN plays THEN 1 WHEN NOT has_play_signal AND lives THEN 1 ELSE 0 END AS play_setter FROM ins
), st AS (
  SELECT *, NOT has_start OR max(starts::INT) OVER w = 1 AS started, max(ends::INT) OVER w = 1 AS ended,
    coalesce(last_value(nullif(fg_setter, 0) IGNORE NULLS) OVER w, 0) AS fg_state, coalesce(last_value(nullif(play_setter, 0) IGNORE NULLS) OVER w, 0) AS play_state
  FROM st0 WINDOW w AS (PARTITION BY session_key ORDER BY event_ms ROWS UNBOUNDED PRECEDING)
), ls0 AS (
  SELECT *, started AND NOT ended AND fg_state = 1 AND play_state = 1 AS is_on FROM st
), ls AS (
  SELECT *, max(CASE WHEN is_on AND lives THEN event_ms END) OVER (PARTITION BY session_key ORDER BY event_ms ROWS UNBOUNDED PRECEDING) AS last_eligible,
    coalesce(lead(event_ms) OVER (PARTITION BY session_key ORDER BY event_ms), (SELECT as_of FROM hz) + {timeout}) AS next_ms FROM ls0
), sg AS (
  SELECT session_key, lifecycle_start, event_ms AS start_ms, least(next_ms, last_eligible + {timeout}) AS end_ms FROM ls
  WHERE is_on AND event_ms < last_eligible + {timeout} AND least(next_ms, last_eligible + {timeout}) > event_ms
), mk AS (
  SELECT *, coalesce(start_ms > max(end_ms) OVER (PARTITION BY session_key ORDER BY start_ms, end_ms ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS opens FROM sg
), nb AS (
  SELECT *, CAST(sum(opens::INT) OVER (PARTITION BY session_key ORDER BY start_ms, end_ms ROWS UNBOUNDED PRECEDING) AS BIGINT) AS interval_index FROM mk
), iv0 AS (
  SELECT session_key, interval_index, min(start_ms) AS start_ms, max(end_ms) AS end_ms, any_value(lifecycle_start) AS lifecycle_start FROM nb GROUP BY session_key, interval_index
), iv AS (
  SELECT iv0.*, fd.user_key, fd.content_id, fd.platform, fd.country, fd.app_version, coalesce(nullif(c.video_type, ''), '__unknown__') AS video_type, coalesce(nullif(c.category, ''), '__unknown__') AS category
  FROM iv0 JOIN fd USING (session_key) LEFT JOIN content c ON c.content_id = fd.content_id
)"""
