"""Queries that users ask of the tiers: panels, rankings, profiles, gates, and plain operators over the other tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumentide.functions import scalars as S
from lumentide.operators import boundaries, corrections, tiers
from lumentide.operators.boundaries import KEYS
from lumentide.plans import gates, guard, profile, registry, router
from lumentide.plans.registry import CURVE0, DAYS_BACK, EVENTS, KEY_SQL, SESSIONS, Model, _points, _rollup, _tier, query
from lumentide.policy import DAY, HOUR, TIER_MASKS

#: The window of the registered queries: all days that the tables have.
WHOLE = f", w AS (SELECT {DAYS_BACK(31)} AS lo, {DAYS_BACK(-1)} AS hi)"
#: A week, for averages of single buckets, whose halves the two engines round apart.
WEEK = f", w AS (SELECT {DAYS_BACK(20)} AS lo, {DAYS_BACK(13)} AS hi)"
IN_WHOLE = "bucket_ms >= lo AND bucket_ms < hi"
NUMBERS = "CAST(sum(active_ms) AS BIGINT) AS active_ms, round(CAST(sum(active_ms) AS BIGINT) / 3600000, 6) AS hours, round(CAST(sum(active_ms) AS BIGINT) / {length}, 6) AS avg_concurrency"


def _whole(m: Model) -> tuple[int, int]:
    return m.day(31), m.day(-1)


def _week(m: Model) -> tuple[int, int]:
    return m.day(20), m.day(13)


def _panel_sql(masks: str, by: str, mask: int, peak: str = "max(peak)", where: str = "true", length: str = "any_value(hi - lo)", window: str = WHOLE) -> str:
    cols = f"{by}, " if by else ""
    return _tier() + window + f" SELECT {cols}{NUMBERS.format(length=length)}, {peak} AS peak FROM tier, w WHERE rollup_mask = {mask} AND {IN_WHOLE} AND {where}" + (f" GROUP BY {by}" if by else "")


@query(_panel_sql("", "bucket_ms", 0, length="3600000", window=WEEK))
def panel_concurrency(m: Model) -> DataFrame:
    return router.panel(m.tier(), *_week(m), ("bucket_ms",), size=HOUR)


@query(_panel_sql("", "platform", 1))
def panel_platform_peak(m: Model) -> DataFrame:
    return router.panel(m.tier(), *_whole(m), ("platform",))


@query(_panel_sql("", "video_type", 8))
def panel_video_type_hours(m: Model) -> DataFrame:
    return router.panel(m.tier(), *_whole(m), ("video_type",))


@query(_panel_sql("", "country", 2))
def panel_country_hours(m: Model) -> DataFrame:
    return router.panel(m.tier(), *_whole(m), ("country",))


@query(_panel_sql("", "platform, country", 3))
def panel_platform_country(m: Model) -> DataFrame:
    return router.panel(m.tier(), *_whole(m), ("platform", "country"))


@query(_panel_sql("", "country", 15, peak="CAST(NULL AS BIGINT)", where="content_id < 20").replace("31::BIGINT", "90::BIGINT").replace("content_id < 20", "content_id = 16"))
def panel_peak_withheld(m: Model) -> DataFrame:
    return router.panel(m.tier(), m.day(90), m.day(-1), ("country",), {"content_id": 16, "platform": "*"})


@query(_panel_sql("", "bucket_ms", 1, where="platform = 'BUILDING'", length="3600000", window=WEEK))
def curve(m: Model) -> DataFrame:
    return router.panel(m.tier(), *_week(m), ("bucket_ms",), {"platform": "BUILDING", "country": ""}, HOUR)


@query(_tier((0,)) + WHOLE + f" SELECT max(peak) AS peak, arg_min(bucket_ms, -peak * 100000000000000 + bucket_ms) AS peak_bucket_ms, round(CAST(sum(active_ms) AS BIGINT) / any_value(hi - lo), 6) AS avg_concurrency, round(CAST(sum(active_ms) AS BIGINT) / 3600000, 6) AS viewing_hours, count(*) AS buckets, min(bucket_ms) AS first_ms, max(bucket_ms) AS last_ms FROM tier, w WHERE {IN_WHOLE}")
def kpi(m: Model) -> DataFrame:
    low, high = _whole(m)
    return router.kpi(m.tier((0,)).where((F.col("bucket_ms") >= low) & (F.col("bucket_ms") < high)), low, high)


@query("SELECT m AS requested_mask, m & 1 > 0 AS filters_platform, m & 2 > 0 AS filters_country, m & 4 > 0 AS filters_content_id, m & 8 > 0 AS filters_video_type, s AS served_by_mask, s IN (0, 1, 2, 3, 4, 5, 8, 9, 15) AS supported FROM (SELECT m::INT AS m, (CASE m WHEN 12 THEN 4 WHEN 13 THEN 5 ELSE m END)::INT AS s FROM range(16) t(m))")
def filter_support(m: Model) -> DataFrame:
    return router.filter_support(m.spark)


@query(_tier((1, 2, 8)) + " SELECT d AS dimension, v AS value, CAST(sum(active_ms) AS BIGINT) AS active_ms FROM (SELECT CASE rollup_mask WHEN 1 THEN 'platform' WHEN 2 THEN 'country' ELSE 'video_type' END AS d, CASE rollup_mask WHEN 1 THEN platform WHEN 2 THEN country ELSE video_type END AS v, active_ms FROM tier) GROUP BY d, v")
def filter_options(m: Model) -> DataFrame:
    return router.filter_options(m.tier((1, 2, 8)))


@query(_tier((4,)) + WHOLE + f" SELECT t.content_id, coalesce(title, '(unknown)') AS title, max(peak) AS peak, CAST(sum(active_ms) AS BIGINT) AS active_ms FROM w, tier t LEFT JOIN content c ON c.content_id = t.content_id WHERE {IN_WHOLE} GROUP BY ALL ORDER BY active_ms DESC, t.content_id LIMIT 10")
def top_content(m: Model) -> DataFrame:
    low, high = _whole(m)
    sums = m.tier((4,)).where((F.col("bucket_ms") >= low) & (F.col("bucket_ms") < high)).groupBy("content_id").agg(F.max("peak").alias("peak"), F.sum("active_ms").alias("active_ms"))
    top = router.page(sums, (F.col("active_ms").desc(), "content_id"), 10)  # ten rows meet the catalogue
    return top.join(m.contents.select("content_id", "title"), "content_id", "left").fillna({"title": "(unknown)"}).select("content_id", "title", "peak", "active_ms")


@query(_rollup((16,)) + " SELECT app_version, max(peak) AS peak, CAST(sum(active_ms) AS BIGINT) AS active_ms FROM rollup GROUP BY 1 ORDER BY active_ms DESC, app_version LIMIT 5")
def rank_dimension(m: Model) -> DataFrame:
    sums = m.rollup((16,)).groupBy("app_version").agg(F.max("peak").alias("peak"), F.sum("active_ms").alias("active_ms"))
    return router.page(sums, (F.col("active_ms").desc(), "app_version"), 5)


@query(_rollup((32,)) + " SELECT category, CAST(sum(active_ms) AS BIGINT) AS active_ms, CAST(sum(sessions_started) AS BIGINT) AS started, round(CAST(sum(active_ms) AS BIGINT) / nullif(CAST(sum(sessions_started) AS BIGINT), 0) / 60000, 6) AS minutes_per_interval FROM rollup GROUP BY 1")
def panel_category_hours(m: Model) -> DataFrame:
    sums = m.rollup((32,)).groupBy("category").agg(F.sum("active_ms").alias("active_ms"), F.sum("sessions_started").alias("started"))
    return sums.withColumn("minutes_per_interval", F.round(F.col("active_ms") / F.nullif("started", F.lit(0)) / 60_000, 6))


@query(_tier((0,)) + " SELECT bucket_ms - bucket_ms % 86400000 AS grain_ms, max(peak) AS peak, round(CAST(sum(active_ms) AS BIGINT) / 86400000, 6) AS avg_of_day, round(CAST(sum(active_ms) AS BIGINT) / (count(*) * 3600000), 6) AS avg_of_active FROM tier GROUP BY 1")
def viewing_trend(m: Model) -> DataFrame:
    out = tiers.coarser(m.tier((0,)), DAY)
    return out.select("grain_ms", "peak", F.round(F.col("active_ms") / DAY, 6).alias("avg_of_day"), F.round(F.col("active_ms") / (F.col("buckets") * HOUR), 6).alias("avg_of_active"))


@query(_tier((0,)) + WHOLE + f" SELECT max(peak) AS peak, round(CAST(sum(active_ms) AS BIGINT) / any_value(greatest(1, hi - lo)), 6) AS avg_requested, round(CAST(sum(active_ms) AS BIGINT) / greatest(1, least(any_value(hi), max(bucket_ms) + 3600000) - greatest(any_value(lo), min(bucket_ms))), 6) AS avg_observed FROM tier, w WHERE {IN_WHOLE}")
def peak_and_average(m: Model) -> DataFrame:
    low, high = _whole(m)
    rows = m.tier((0,)).where((F.col("bucket_ms") >= low) & (F.col("bucket_ms") < high))
    seen = F.least(F.lit(high), F.max("bucket_ms") + HOUR) - F.greatest(F.lit(low), F.min("bucket_ms"))
    return rows.agg(F.max("peak").alias("peak"), F.round(F.sum("active_ms") / (high - low), 6).alias("avg_requested"), F.round(F.sum("active_ms") / F.greatest(seen, F.lit(1)), 6).alias("avg_observed"))


@query(_tier((1,)) + " SELECT platform, CAST(sum(active_ms) AS BIGINT) AS active_ms, round(100.0 * CAST(sum(active_ms) AS BIGINT) / sum(CAST(sum(active_ms) AS BIGINT)) OVER (), 6)::DOUBLE AS share_pct FROM tier GROUP BY platform")
def share_pct(m: Model) -> DataFrame:
    return router.shares(m.tier((1,)), "platform", "active_ms")


@query(_tier((2,)) + ", tp AS (SELECT country FROM tier GROUP BY 1 ORDER BY sum(active_ms) DESC, country LIMIT 10) SELECT CASE WHEN country IN (FROM tp) THEN country ELSE 'other' END AS member, bucket_ms - bucket_ms % 86400000 AS day_ms, CAST(sum(active_ms) AS BIGINT) AS active_ms FROM tier GROUP BY ALL")
def top_n_other(m: Model) -> DataFrame:
    return router.top_and_other(m.tier((2,)).withColumn("day_ms", S.bucket(F.col("bucket_ms"), DAY)), "country", "active_ms", 10, "day_ms")


@query(_tier((3,)) + " SELECT DISTINCT platform || ' · ' || country AS label FROM tier")
def dimension_labels(m: Model) -> DataFrame:
    return m.tier((3,)).select(S.label(F.col("platform"), F.col("country"), F.col("video_type")).alias("label")).distinct()


@query("SELECT p_partkey AS content_id, p_name AS title, p_type AS video_type, p_brand AS category FROM part WHERE contains(lower(p_name), 'a') OR contains(lower(p_brand), 'a') ORDER BY length(p_name), p_partkey LIMIT 25")
def content_search(m: Model) -> DataFrame:
    return router.search(m.contents, "A", 25)


@query(SESSIONS + " SELECT (SELECT h FROM hz) AS horizon_ms, (SELECT max(end_ms) FROM iv0) AS last_end_ms, (SELECT count(*) FROM iv0) AS intervals, (SELECT count(DISTINCT session_key) FROM iv0) AS sessions, (SELECT count(*) FROM dd WHERE content_id NOT IN (SELECT content_id FROM content)) AS unknown_content_events")
def data_health(m: Model) -> DataFrame:
    got = m.bare.agg(F.max("end_ms").alias("last_end_ms"), F.count("*").alias("intervals"), F.count_distinct("session_key").alias("sessions"))
    unknown = m.events.join(m.contents.select("content_id"), "content_id", "left_anti").agg(F.count("*").alias("unknown_content_events"))
    return got.crossJoin(unknown).select(F.lit(m.horizon).alias("horizon_ms"), "last_end_ms", "intervals", "sessions", "unknown_content_events")


@query(_tier((0,)) + " SELECT bucket_ms AS busiest_ms, active_ms, min(bucket_ms) OVER () AS from_ms, max(bucket_ms) OVER () + 3600000 AS to_ms FROM tier QUALIFY row_number() OVER (ORDER BY active_ms DESC, bucket_ms) = 1")
def busiest_hour(m: Model) -> DataFrame:
    t = m.tier((0,))
    return t.agg(F.min_by("bucket_ms", F.struct(-F.col("active_ms"), "bucket_ms")).alias("busiest_ms"), F.max("active_ms").alias("active_ms"), F.min("bucket_ms").alias("from_ms"), (F.max("bucket_ms") + HOUR).alias("to_ms"))


@query(_tier((1,)) + " SELECT platform, CAST(sum(active_ms) AS BIGINT) AS ms FROM tier GROUP BY platform HAVING sum(active_ms) > 0 LIMIT 1000")
def guarded_select(m: Model) -> DataFrame:
    return guard.run_select(m.spark, "WITH t AS (SELECT platform, active_ms FROM served_tier) SELECT platform, sum(active_ms) AS ms FROM t GROUP BY platform HAVING sum(active_ms) > 0;", {"served_tier": m.tier((1,))})


@query(_tier((0, 1)) + f" SELECT {KEY_SQL}, bucket_ms, active_ms FROM tier ORDER BY active_ms DESC, rollup_mask, platform, bucket_ms LIMIT 30 OFFSET 20")
def paging(m: Model) -> DataFrame:
    return router.page(m.tier((0, 1)).select(*KEYS, "bucket_ms", "active_ms"), (F.col("active_ms").desc(), "rollup_mask", "platform", "bucket_ms"), 30, 20)


@query(SESSIONS + CURVE0 + WHOLE + ", x AS (SELECT max(level) AS peak, CAST(sum(level * (least(end_ms, hi) - greatest(start_ms, lo))) AS BIGINT) AS active_ms, any_value(hi - lo) AS len FROM s0, w WHERE start_ms < hi AND end_ms > lo) SELECT 'tier' AS route, peak, round(active_ms / len, 6) AS avg_concurrency FROM x UNION ALL SELECT 'exact', peak, round(active_ms / len, 6) FROM x")
def served_range(m: Model) -> DataFrame:
    low, high = _whole(m)
    return router.served_range(m.tier((0,)), m.total(), low, high, HOUR).unionByName(router.served_range(m.tier((0,)), m.total(), low, high, HOUR, exact=True))


@query(_tier((0,)) + " SELECT bucket_ms, peak, round(active_ms / 3600000, 6) AS avg_concurrency FROM tier ORDER BY bucket_ms DESC LIMIT 1")
def tile_concurrent_now(m: Model) -> DataFrame:
    return router.page(m.tier((0,)).select("bucket_ms", "peak", F.round(F.col("active_ms") / HOUR, 6).alias("avg_concurrency")), (F.col("bucket_ms").desc(),), 1)


@query(_tier((4,)) + WHOLE + f", tp AS (SELECT content_id FROM tier, w WHERE {IN_WHOLE} GROUP BY 1 ORDER BY sum(active_ms) DESC, content_id LIMIT 8) SELECT bucket_ms, content_id, round(active_ms / 3600000, 6) AS avg_concurrency FROM tier, w WHERE {IN_WHOLE} AND content_id IN (FROM tp)")
def tile_top_series(m: Model) -> DataFrame:
    low, high = _whole(m)
    rows = m.tier((4,)).where((F.col("bucket_ms") >= low) & (F.col("bucket_ms") < high))
    top = router.page(rows.groupBy("content_id").agg(F.sum("active_ms").alias("ms")), (F.col("ms").desc(), "content_id"), 8)
    return rows.join(top, "content_id", "left_semi").select("bucket_ms", "content_id", F.round(F.col("active_ms") / HOUR, 6).alias("avg_concurrency"))


@query(_tier((0, 1, 2, 8)) + " SELECT CASE rollup_mask WHEN 0 THEN 'total' WHEN 1 THEN 'platform' WHEN 2 THEN 'country' ELSE 'video type' END AS grouping, bucket_ms - bucket_ms % 86400000 AS day_ms, count(DISTINCT platform || '/' || country || '/' || video_type) AS slices, max(peak) AS highest, CAST(sum(active_ms) AS BIGINT) AS active_ms FROM tier GROUP BY ALL")
def tile_groupings_by_day(m: Model) -> DataFrame:
    t = m.tier((0, 1, 2, 8))
    name = F.concat_ws("/", "platform", "country", "video_type")
    return t.groupBy(S.grouping(F.col("rollup_mask")).alias("grouping"), S.bucket(F.col("bucket_ms"), DAY).alias("day_ms")).agg(F.count_distinct(name).alias("slices"), F.max("peak").alias("highest"), F.sum("active_ms").alias("active_ms"))


@query(SESSIONS + " SELECT h AS horizon_ms, as_of AS as_of_ms, (SELECT max(end_ms) FROM iv0) - h AS provisional_ms, (SELECT count(*) FROM iv0 WHERE end_ms > h) AS provisional FROM hz")
def data_freshness(m: Model) -> DataFrame:
    return m.bare.agg((F.max("end_ms") - m.horizon).alias("provisional_ms"), F.count_if(F.col("end_ms") > m.horizon).alias("provisional")).select(F.lit(m.horizon).alias("horizon_ms"), F.lit(m.as_of).alias("as_of_ms"), "provisional_ms", "provisional")


@query(EVENTS + " SELECT event_ms - event_ms % 3600000 AS bucket_ms, round(count(*) / 3600.0, 6)::DOUBLE AS rows_a_second, count(DISTINCT session_key) AS dirtied, round(quantile_cont(row_version % 97, 0.5), 6) AS lag_p50, round(quantile_cont(row_version % 97, 0.99), 6) AS lag_p99 FROM ev WHERE row_version < 1000000000 GROUP BY 1")
def ingest_observability(m: Model) -> DataFrame:
    lag = F.col("row_version") % 97
    rows = m.raw.where("row_version < 1000000000").groupBy(S.bucket(F.col("event_ms"), HOUR).alias("bucket_ms"))
    return rows.agg(F.round(F.count("*") / 3600.0, 6).alias("rows_a_second"), F.count_distinct("session_key").alias("dirtied"), F.round(F.percentile(lag, F.lit(0.5)), 6).alias("lag_p50"), F.round(F.percentile(lag, F.lit(0.99)), 6).alias("lag_p99"))


@query(EVENTS + " SELECT session_key, event_ms FROM dd WHERE event_ms > (SELECT max(event_ms) FROM dd) - 3 * 86400000")
def retention(m: Model) -> DataFrame:
    return corrections.retained(m.events.select("session_key", "event_ms"), "event_ms", m.horizon, 3 * DAY)


@query("SELECT p_partkey AS content_id, p_name || ' (new)' AS title, 2 AS source_version FROM part WHERE p_partkey % 2 = 0 UNION ALL SELECT p_partkey, p_name, 1 FROM part WHERE p_partkey % 2 <> 0")
def content_current(m: Model) -> DataFrame:
    from lumentide.sources.readers import latest_content

    first = m.contents.select("content_id", "title", F.lit(1).alias("source_version"))
    second = first.where("content_id % 2 = 0").select("content_id", F.concat("title", F.lit(" (new)")).alias("title"), F.lit(2).alias("source_version"))
    return latest_content(first.unionByName(second))


@query(EVENTS + " SELECT * FROM (SELECT 'events' AS gate, count(*) AS actual FROM ev UNION ALL SELECT 'keys', count(*) FROM dd UNION ALL SELECT 'sessions', count(DISTINCT session_key) FROM dd UNION ALL SELECT 'starts', count(*) FROM dd WHERE signal = 'session_start' UNION ALL SELECT 'pings', count(*) FROM dd WHERE event IN ('network-activity', 'buffer-health', 'video-resize') UNION ALL SELECT 'null keys', count(*) FROM dd WHERE session_key IS NULL)")
def verify_suite(m: Model) -> DataFrame:
    e = m.events
    n = F.count("*")
    every = [gates.gate(m.raw, "events", n), gates.gate(e, "keys", n), gates.gate(e, "sessions", F.count_distinct("session_key")), gates.gate(e, "starts", F.count_if(F.col("signal") == "session_start")), gates.gate(e, "pings", F.count_if("is_periodic_ping")), gates.gate(e, "null keys", F.count_if(F.col("session_key").isNull()))]
    return gates.union(every).drop("passed")


# --- profile -------------------------------------------------------------------------------------


@query(EVENTS + " SELECT count(*) AS events, count(DISTINCT session_key) AS sessions, count(DISTINCT user_key) AS users, count(DISTINCT content_id) AS contents, min(event_ms) AS first_ms, max(event_ms) AS last_ms, count(*) FILTER (signal = 'session_start') AS starts FROM dd")
def profile_rows(m: Model) -> DataFrame:
    return profile.rows(m.events)


@query(EVENTS + " SELECT strftime(epoch_ms(event_ms), '%Y-%m-%d') AS utc_date, count(*) AS events, count(*) FILTER ((event_ms + 19800000) // 86400000 <> event_ms // 86400000) AS other_local_date FROM dd GROUP BY 1")
def profile_local_dates(m: Model) -> DataFrame:
    return profile.local_dates(m.events)


@query(EVENTS + ", g AS (SELECT event_ms - lag(event_ms) OVER (PARTITION BY session_key ORDER BY event_ms, row_version) AS gap FROM dd) SELECT count(gap) AS gaps, round(quantile_cont(gap, 0.5), 3) AS p50, round(quantile_cont(gap, 0.9), 3) AS p90, round(quantile_cont(gap, 0.99), 3) AS p99 FROM g")
def profile_cadence(m: Model) -> DataFrame:
    return profile.cadence(m.events)


@query(SESSIONS + " SELECT round(quantile_cont(d, 0.25), 3) AS p25, round(quantile_cont(d, 0.5), 3) AS p50, round(quantile_cont(d, 0.75), 3) AS p75, round(quantile_cont(d, 0.95), 3) AS p95, max(d) AS longest, round(avg(d), 3) AS mean FROM (SELECT end_ms - start_ms AS d FROM iv0)")
def profile_quantiles(m: Model) -> DataFrame:
    return profile.quantiles(m.bare)


@query(EVENTS + " SELECT count(DISTINCT platform) AS platform, count(DISTINCT country) AS country, count(DISTINCT app_version) AS app_version, count(DISTINCT event_type) AS event_type, count(DISTINCT event) AS event, count(DISTINCT signal) AS signal FROM dd")
def profile_cardinality(m: Model) -> DataFrame:
    return profile.cardinality(m.events)


@query(EVENTS + " SELECT content_id, count(*) AS events FROM dd WHERE NOT EXISTS (SELECT 1 FROM content c WHERE c.content_id = dd.content_id) GROUP BY 1")
def profile_missing_dims(m: Model) -> DataFrame:
    return profile.missing_contents(m.events, m.contents)


@query(EVENTS + " SELECT session_key, count(DISTINCT content_id) AS contents, count(DISTINCT app_version) AS versions, count(DISTINCT platform) AS platforms FROM dd GROUP BY 1 HAVING count(DISTINCT content_id) > 1 OR count(DISTINCT app_version) > 1 OR count(DISTINCT platform) > 1")
def dimension_drift(m: Model) -> DataFrame:
    return profile.drift(m.events)


@query(EVENTS + " SELECT user_key, count(DISTINCT session_key) AS sessions FROM dd GROUP BY 1 HAVING count(DISTINCT session_key) >= 2")
def profile_multi_session_users(m: Model) -> DataFrame:
    return profile.many_sessions(m.events)


@query(EVENTS + ", l AS (SELECT greatest(coalesce(max(event_ms) OVER (PARTITION BY session_key ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - event_ms, 0), 0) AS late FROM (SELECT *, row_version * 7919 % 1000003 AS v FROM raw)) SELECT count(*) FILTER (late > 0) AS late_events, max(late) AS most_late_ms FROM l")
def profile_lateness(m: Model) -> DataFrame:
    shuffled = m.raw.where("row_version < 1000000000").withColumn("row_version", F.col("row_version") * 7919 % 1000003)
    return profile.out_of_order(shuffled)


# --- gates ---------------------------------------------------------------------------------------


@query(_tier() + " SELECT rollup_mask, t AS tier_ms, i AS interval_ms, t = i AS passed FROM (SELECT rollup_mask, CAST(sum(active_ms) AS BIGINT) AS t FROM tier GROUP BY 1) JOIN (SELECT rollup_mask, CAST(sum(end_ms - start_ms) AS BIGINT) AS i FROM fan GROUP BY 1) USING (rollup_mask)")
def gate_conservation(m: Model) -> DataFrame:
    fanned = m.fan()
    return gates.conservation(fanned, tiers.dense_tier(fanned, boundaries.deltas(fanned), HOUR))


@query("SELECT g AS gate, CAST(a AS BIGINT) AS actual, true AS passed FROM (VALUES ('opens equal closes', 0), ('no level below zero', 0), ('no empty interval', 0), ('one row for each key', 0), ('only known masks', 0), ('all masks there', 9), ('time within peak', 0), ('ending within peak', 0), ('time conserved', 0), ('peaks equal the sweep', 0)) t(g, a)")
def gate_build(m: Model) -> DataFrame:
    build = m.build()
    fanned = boundaries.fan_out(build.intervals, TIER_MASKS)
    return gates.build_gates(build.intervals, fanned, build.points, build.tier, TIER_MASKS, HOUR)


@query(_tier((1,)) + " SELECT platform, max(peak) AS served, (SELECT max(level) FROM cv WHERE cv.platform = tier.platform) AS swept FROM tier GROUP BY platform")
def gate_peak_sweep(m: Model) -> DataFrame:
    points = m.points((1,))
    served = m.tier((1,)).groupBy("platform").agg(F.max("peak").alias("served"))
    return served.join(boundaries.curve(points).groupBy("platform").agg(F.max("level").alias("swept")), "platform")


@query(_points((0, 1)) + " SELECT coalesce(a.boundary_ms, b.boundary_ms) AS boundary_ms, coalesce(a.n, 0) AS left_value, coalesce(b.n, 0) AS right_value FROM (SELECT boundary_ms, CAST(sum(opens) AS BIGINT) AS n FROM dl WHERE rollup_mask = 0 GROUP BY 1) a FULL JOIN (SELECT boundary_ms, CAST(sum(opens) AS BIGINT) AS n FROM dl WHERE rollup_mask = 1 AND platform <> 'BUILDING' GROUP BY 1) b USING (boundary_ms) WHERE coalesce(a.n, 0) <> coalesce(b.n, 0)")
def gate_full_outer_diff(m: Model) -> DataFrame:
    p = m.points((0, 1))
    total = p.where("rollup_mask = 0").groupBy("boundary_ms").agg(F.sum("opens").alias("n"))
    rest = p.where("rollup_mask = 1 and platform <> 'BUILDING'").groupBy("boundary_ms").agg(F.sum("opens").alias("n"))
    return corrections.difference(total, rest, ("boundary_ms",), "n")


@query(_points((0,)) + " SELECT session_key, start_ms FROM iv0 EXCEPT SELECT session_key, start_ms FROM iv0 WHERE interval_index > 1")
def gate_except(m: Model) -> DataFrame:
    return m.bare.select("session_key", "start_ms").exceptAll(m.bare.where("interval_index > 1").select("session_key", "start_ms"))


@query(_tier((0, 5)) + f" SELECT {KEY_SQL}, bucket_ms, count(*) AS n FROM (SELECT * FROM tier UNION ALL SELECT * FROM tier WHERE rollup_mask = 0) GROUP BY ALL HAVING count(*) > 1")
def gate_duplicate_keys(m: Model) -> DataFrame:
    t = m.tier((0, 5))
    return t.unionByName(t.where("rollup_mask = 0")).groupBy(*KEYS, "bucket_ms").agg(F.count("*").alias("n")).where("n > 1")


@query(_tier() + " SELECT rollup_mask, count(*) AS n FROM tier GROUP BY 1")
def gate_mask_set(m: Model) -> DataFrame:
    return m.tier().groupBy("rollup_mask").agg(F.count("*").alias("n"))


# --- operators that need no session --------------------------------------------------------------


@query("SELECT n_name, count(c_custkey) AS customers FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY n_name")
def left_join_counts(m: Model) -> DataFrame:
    return m.table("nation").join(m.table("customer"), F.col("c_nationkey") == F.col("n_nationkey"), "left").groupBy("n_name").agg(F.count("c_custkey").alias("customers"))


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def anti_join(m: Model) -> DataFrame:
    return m.table("customer").join(m.table("orders"), F.col("o_custkey") == F.col("c_custkey"), "left_anti").select("c_custkey")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 49 AND l_returnflag = 'R')")
def semi_join(m: Model) -> DataFrame:
    return m.table("orders").join(m.table("lineitem").where("l_quantity > 49 and l_returnflag = 'R'"), F.col("l_orderkey") == F.col("o_orderkey"), "left_semi").select("o_orderkey")


@query("SELECT l_orderkey, l_linenumber, l_quantity, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_linenumber) AS place FROM lineitem QUALIFY place = 1")
def latest_by_row_number(m: Model) -> DataFrame:
    w = Window.partitionBy("l_orderkey").orderBy(F.col("l_quantity").desc(), "l_linenumber")
    return m.table("lineitem").select("l_orderkey", "l_linenumber", "l_quantity", F.row_number().over(w).cast("long").alias("place")).where("place = 1")


@query("SELECT l_returnflag, l_linestatus, count(*) AS lines, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity, grouping_id(l_returnflag, l_linestatus)::BIGINT AS level FROM lineitem GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_returnflag), ())")
def grouping_sets(m: Model) -> DataFrame:
    m.table("lineitem").createOrReplaceTempView("lumentide_lineitem")
    return m.spark.sql("SELECT l_returnflag, l_linestatus, count(*) AS lines, sum(CAST(l_quantity AS BIGINT)) AS quantity, grouping_id(l_returnflag, l_linestatus) AS level FROM lumentide_lineitem GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_returnflag), ())")


@query("SELECT r_name, round(median(c_acctbal), 4) AS med, round(quantile_cont(c_acctbal, 0.9), 4) AS p90 FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name")
def quantiles_exact(m: Model) -> DataFrame:
    rows = m.table("customer").join(m.table("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(m.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return rows.groupBy("r_name").agg(F.round(F.percentile("c_acctbal", F.lit(0.5)), 4).alias("med"), F.round(F.percentile("c_acctbal", F.lit(0.9)), 4).alias("p90"))


@query("SELECT CAST(s_nationkey AS BIGINT) AS k FROM supplier UNION SELECT CAST(c_nationkey AS BIGINT) FROM customer")
def union_distinct(m: Model) -> DataFrame:
    return m.table("supplier").select(F.col("s_nationkey").cast("long").alias("k")).union(m.table("customer").select(F.col("c_nationkey").cast("long"))).distinct()


@query("SELECT CAST(s_nationkey AS BIGINT) AS k FROM supplier INTERSECT SELECT CAST(c_nationkey AS BIGINT) FROM customer WHERE c_acctbal > 9000")
def set_intersect(m: Model) -> DataFrame:
    return m.table("supplier").select(F.col("s_nationkey").cast("long").alias("k")).intersect(m.table("customer").where("c_acctbal > 9000").select(F.col("c_nationkey").cast("long").alias("k")))


__all__ = ["registry"]
