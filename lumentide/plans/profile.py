"""Data profile of loaded events: one DataFrame for each question."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumentide.operators.sessions import EVENT_KEY


def rows(events: DataFrame) -> DataFrame:
    return events.agg(F.count("*").alias("events"), F.count_distinct("session_key").alias("sessions"), F.count_distinct("user_key").alias("users"), F.count_distinct("content_id").alias("contents"), F.min("event_ms").alias("first_ms"), F.max("event_ms").alias("last_ms"), F.count_if(F.col("signal") == "session_start").alias("starts"))


def local_dates(events: DataFrame, zone: str = "Asia/Kolkata") -> DataFrame:
    """Events whose local date is not their UTC date, by UTC date."""
    at = F.timestamp_millis("event_ms")
    d, local = F.to_date(at), F.to_date(F.from_utc_timestamp(at, zone))
    return events.groupBy(F.date_format(d, "yyyy-MM-dd").alias("utc_date")).agg(F.count("*").alias("events"), F.count_if(d != local).alias("other_local_date"))


def multiplicity(events: DataFrame) -> DataFrame:
    """Copies beyond the first, the most copies of one key, and keys with copies that differ in content."""
    per = events.groupBy(*EVENT_KEY).agg(F.count("*").alias("n"), F.count_distinct("content_id").alias("kinds"))
    return per.agg(F.count("*").alias("keys"), F.sum(F.greatest(F.col("n") - 1, F.lit(0))).alias("copies"), F.max("n").alias("most"), F.count_if(F.col("kinds") > 1).alias("conflicts"))


def cadence(events: DataFrame) -> DataFrame:
    """Quantiles of the gap between a session's events, in milliseconds."""
    gap = F.col("event_ms") - F.lag("event_ms").over(Window.partitionBy("session_key").orderBy("event_ms", "row_version"))
    q = F.percentile("gap", F.array(F.lit(0.5), F.lit(0.9), F.lit(0.99)))
    return events.select(gap.alias("gap")).where("gap is not null").agg(F.count("*").alias("gaps"), q.alias("q")).select("gaps", *[F.round(F.get("q", F.lit(i)), 3).alias(n) for i, n in enumerate(("p50", "p90", "p99"))])


def quantiles(intervals: DataFrame) -> DataFrame:
    """Durations of intervals."""
    length = F.col("end_ms") - F.col("start_ms")
    q = F.percentile(length, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75), F.lit(0.95)))
    return intervals.agg(q.alias("q"), F.max(length).alias("longest"), F.round(F.avg(length), 3).alias("mean")).select(*[F.round(F.get("q", F.lit(i)), 3).alias(n) for i, n in enumerate(("p25", "p50", "p75", "p95"))], "longest", "mean")


def cardinality(events: DataFrame) -> DataFrame:
    return events.agg(*[F.count_distinct(c).alias(c) for c in ("platform", "country", "app_version", "event_type", "event", "signal")])


def missing_contents(events: DataFrame, contents: DataFrame) -> DataFrame:
    """content_id, events of contents that the catalogue does not know."""
    return events.join(contents.select("content_id"), "content_id", "left_anti").groupBy("content_id").agg(F.count("*").alias("events"))


def drift(events: DataFrame) -> DataFrame:
    """Sessions whose events disagree on a dimension that should be fixed."""
    per = events.groupBy("session_key").agg(F.count_distinct("content_id").alias("contents"), F.count_distinct("app_version").alias("versions"), F.count_distinct("platform").alias("platforms"))
    return per.where("contents > 1 or versions > 1 or platforms > 1")


def many_sessions(events: DataFrame, least: int = 2) -> DataFrame:
    return events.groupBy("user_key").agg(F.count_distinct("session_key").alias("sessions")).where(F.col("sessions") >= least)


def out_of_order(events: DataFrame) -> DataFrame:
    """By hour of event: events that arrive after a later one of their session, and by how much at most."""
    newest = F.max("event_ms").over(Window.partitionBy("session_key").orderBy("row_version").rowsBetween(Window.unboundedPreceding, -1))
    late = F.greatest(newest - F.col("event_ms"), F.lit(0))
    return events.select(late.alias("late")).agg(F.count_if(F.col("late") > 0).alias("late_events"), F.coalesce(F.max("late"), F.lit(0)).alias("most_late_ms"))
