"""Questions with parameters: windows by clip and entity, content and dimension lists, one session as of an instant, sealed days, lagged publication, tiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumentide.functions import scalars as S
from lumentide.operators import boundaries, corrections, sessions, tiers
from lumentide.operators.boundaries import KEYS
from lumentide.plans import gates, registry, router
from lumentide.plans.registry import DAYS_BACK, EVENTS, KEY_SQL, SESSIONS, USERS, Model, _points, _rollup, _tier, query
from lumentide.plans.serving import IN_WHOLE, WHOLE, _whole
from lumentide.policy import DAY, HOUR, WIDE

#: The catalogue's answer for a content that it does not know.
UNKNOWN = "__unknown__"
STALE_MS = 900_000
VALUES = 200


def variant_tier(m: Model, masks: tuple[int, ...], clip: str = "unclipped", entity: str = "session", generation: int = 1) -> DataFrame:
    """The dense tier of one clip variant and entity: sessions, or users, who count once however many sessions they watch."""
    fanned = boundaries.fan_out(sessions.clip_variants(m.kept, m.horizon).where(F.col("clip_variant") == clip), masks)
    if entity == "user":
        fanned = corrections.user_intervals(fanned)
    tier = tiers.dense_tier(fanned, boundaries.deltas(fanned), m.policy.bucket_ms)
    return tier.select(F.lit(generation).alias("generation"), F.lit(entity).alias("entity"), F.lit(clip).alias("clip_variant"), *tier.columns)


def touching(intervals: DataFrame, low: int, high: int, look_back: int) -> DataFrame:
    """Intervals of sessions that began at most ``look_back`` before the window and that meet it, cut to it: a stored table prunes by the begin's date."""
    near = intervals.where((F.col("lifecycle_start") >= low - look_back) & (F.col("lifecycle_start") < high))
    met = near.where((F.col("start_ms") < high) & (F.col("end_ms") > low))
    return met.withColumns({"start_ms": F.greatest("start_ms", F.lit(low)), "end_ms": F.least("end_ms", F.lit(high))})


CLIPPED = SESSIONS.replace("), iv AS (", "), iv_all AS (") + ", iv AS (SELECT * REPLACE (least(end_ms, (SELECT h FROM hz)) AS end_ms) FROM iv_all WHERE least(end_ms, (SELECT h FROM hz)) > start_ms)"


def _clipped_tier(masks: tuple[int, ...], users: bool) -> str:
    chain = CLIPPED + boundaries.SQL.format(masks=list(masks))
    if users:
        chain = chain.replace(", dl AS (", USERS.replace("FROM fan)", "FROM fan0)", 1) + ", fan AS (SELECT * FROM ui), dl AS (").replace(", fan AS (", ", fan0 AS (", 1)
    return chain + tiers.SQL.format(size=HOUR)


@query(_clipped_tier((0, 1), True) + f" SELECT 1 AS generation, 'user' AS entity, 'clipped' AS clip_variant, {KEY_SQL}, bucket_ms, peak, active_ms, ending_concurrency, boundary_points FROM tier")
def tier_users_clipped(m: Model) -> DataFrame:
    return variant_tier(m, (0, 1), "clipped", "user")


@query(_clipped_tier((1,), False) + WHOLE + f" SELECT bucket_ms, peak, (active_ms // 3600) / 1000.0::DOUBLE AS avg_concurrency FROM tier, w WHERE platform = 'BUILDING' AND {IN_WHOLE}")
def curve_clipped(m: Model) -> DataFrame:
    low, high = _whole(m)
    rows = variant_tier(m, (1,), "clipped").where((F.col("platform") == "BUILDING") & (F.col("bucket_ms") >= low) & (F.col("bucket_ms") < high))
    return rows.select("bucket_ms", "peak", thousandths("active_ms", HOUR).alias("avg_concurrency"))


@query(_clipped_tier((0,), True) + WHOLE + f" SELECT max(peak) AS peak, CAST(sum(active_ms) AS BIGINT) AS active_ms, round(CAST(sum(active_ms) AS BIGINT) / any_value(hi - lo), 6) AS avg_concurrency FROM tier, w WHERE {IN_WHOLE}")
def kpi_users(m: Model) -> DataFrame:
    low, high = _whole(m)
    rows = variant_tier(m, (0,), "clipped", "user").where((F.col("bucket_ms") >= low) & (F.col("bucket_ms") < high))
    return rows.agg(F.max("peak").alias("peak"), F.sum("active_ms").alias("active_ms"), F.round(F.sum("active_ms") / (high - low), 6).alias("avg_concurrency"))


@query(_tier((4,)) + WHOLE + f" SELECT t.content_id, coalesce(c.title, '(unknown)') AS title, coalesce(nullif(c.video_type, ''), '{UNKNOWN}') AS video_type, coalesce(nullif(c.category, ''), '{UNKNOWN}') AS category, max(peak) AS peak, CAST(sum(active_ms) AS BIGINT) AS active_ms, round(CAST(sum(active_ms) AS BIGINT) / any_value(hi - lo), 6) AS avg_concurrency FROM w, tier t LEFT JOIN content c ON c.content_id = t.content_id WHERE {IN_WHOLE} GROUP BY ALL")
def dash_content(m: Model) -> DataFrame:
    low, high = _whole(m)
    sums = router.panel(m.tier((4,)), low, high, ("content_id",)).select("content_id", "peak", "active_ms", "avg_concurrency")
    known = m.contents.select("content_id", "title", F.nullif("video_type", F.lit("")).alias("video_type"), F.nullif("category", F.lit("")).alias("category"))
    return sums.join(known, "content_id", "left").fillna({"title": "(unknown)", "video_type": UNKNOWN, "category": UNKNOWN})


@query(SESSIONS + f"{WHOLE} SELECT country AS value, CAST(sum(least(end_ms, hi) - greatest(start_ms, lo)) AS BIGINT) AS active_ms FROM iv, w WHERE start_ms < hi AND end_ms > lo AND lifecycle_start >= lo - 30::BIGINT * 86400000 AND lifecycle_start < hi GROUP BY 1 ORDER BY active_ms DESC, value LIMIT {VALUES}")
def dimension_values(m: Model) -> DataFrame:
    low, high = _whole(m)
    sums = touching(m.intervals, low, high, 30 * DAY).groupBy(F.col("country").alias("value")).agg(F.sum(F.col("end_ms") - F.col("start_ms")).alias("active_ms"))
    return router.page(sums, (F.col("active_ms").desc(), "value"), VALUES)


AS_OF = EVENTS + """, top AS (SELECT session_key AS k FROM dd GROUP BY 1 ORDER BY count(*) DESC, session_key LIMIT 1), cut AS (SELECT max(event_ms) - 864000000 AS t FROM dd), one AS (SELECT dd.* FROM dd, top, cut WHERE session_key = k AND event_ms <= t)""" + sessions.SQL.format(timeout=WIDE.timeout_ms).replace("SELECT max(event_ms) AS h, max(event_ms) + 43200000 AS as_of FROM dd", "SELECT t AS h, t AS as_of FROM cut").replace("FROM dd", "FROM one")


@query(AS_OF + " SELECT session_key, interval_index, start_ms, least(end_ms, (SELECT h FROM hz)) AS end_ms, end_ms > (SELECT h FROM hz) AS open FROM iv0 WHERE start_ms < (SELECT h FROM hz)")
def session_as_of(m: Model) -> DataFrame:
    busiest = m.events.groupBy("session_key").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "session_key").limit(1)
    return one_session(m, busiest.first()["session_key"], m.horizon - 10 * DAY)


def one_session(m: Model, key: int, at: int) -> DataFrame:
    """The intervals of a session by what was known at an instant; one that was open then ends there."""
    own = m.raw.where((F.col("session_key") == key) & (F.col("event_ms") <= at))
    made = sessions.active_intervals(sessions.dedup_latest(own), m.policy, at).where(F.col("start_ms") < at)
    return made.select("session_key", "interval_index", "start_ms", F.least("end_ms", F.lit(at)).alias("end_ms"), (F.col("end_ms") > at).alias("open"))


def sealed_day(points: DataFrame, anchors: DataFrame, day: int, size: int) -> DataFrame:
    """bucket_ms, peak, active_ms, ending_concurrency of the total on one day, from its anchor and its own boundaries only."""
    start = anchors.where(F.col("day_ms") == day).select(F.lit(day).alias("at"), F.col("level").alias("d"))
    own = points.where((F.col("boundary_ms") >= day) & (F.col("boundary_ms") < day + DAY)).select(F.col("boundary_ms").alias("at"), (F.col("opens") - F.col("closes")).alias("d"))
    rows = start.unionByName(own).groupBy("at").agg(F.sum("d").alias("d")).withColumn("day_ms", F.lit(day))
    parts = boundaries.swept(rows, F.col("d"), ("day_ms",), "at").select(F.col("at").alias("start_ms"), F.coalesce("next", F.lit(day + DAY)).alias("end_ms"), "level").where("level > 0")
    met = boundaries.spread(parts, size)
    ends = F.least("end_ms", F.col("bucket_ms") + size)
    return met.groupBy("bucket_ms").agg(F.max("level").alias("peak"), F.sum(F.col("level") * F.col("overlap_ms")).alias("active_ms"), F.max_by("level", ends).alias("ending_concurrency"))


@query(SESSIONS + registry.CURVE0 + f", d AS (SELECT {DAYS_BACK(15)} AS lo), p AS (SELECT greatest(start_ms, lo) AS a, least(end_ms, lo + 86400000) AS b, level FROM s0, d WHERE start_ms < lo + 86400000 AND end_ms > lo AND level > 0), x AS (SELECT unnest(generate_series(a - a % 3600000, b - 1 - (b - 1) % 3600000, 3600000)) AS bucket_ms, * FROM p) SELECT bucket_ms, max(level) AS peak, CAST(sum(level * (least(b, bucket_ms + 3600000) - greatest(a, bucket_ms))) AS BIGINT) AS active_ms, arg_max(level, least(b, bucket_ms + 3600000)) AS ending_concurrency FROM x GROUP BY 1")
def sealed_day_refresh(m: Model) -> DataFrame:
    points = m.scratch.write(m.total())
    return sealed_day(points, boundaries.day_anchors(points, ("rollup_mask",)), m.day(15), HOUR)


def publish_until(horizon: int, lag: int, size: int) -> int:
    """Up to where buckets are published: whole ones, behind the horizon by the lag."""
    return (horizon - lag) // size * size


@query(_rollup((0, 1)).replace("), iv AS (", "), iv_all AS (", 1).replace(", m AS (", ", iv AS (SELECT * REPLACE (least(end_ms, until) AS end_ms) FROM iv_all, (SELECT h - 300000 - (h - 300000) % 3600000 AS until FROM hz) WHERE start_ms < until), m AS (", 1) + " SELECT rollup_mask, platform, bucket_ms, peak, active_ms, sessions_active, sessions_started FROM rollup, hz WHERE bucket_ms < h - 300000 - (h - 300000) % 3600000")
def rollup_published(m: Model) -> DataFrame:
    until = publish_until(m.horizon, 300_000, HOUR)
    cut = m.intervals.where(F.col("start_ms") < until).withColumn("end_ms", F.least("end_ms", F.lit(until)))
    rows = tiers.minute_rollup(boundaries.fan_out(cut, (0, 1), "app_version", "category"), HOUR)
    return rows.where(F.col("bucket_ms") < until).select("rollup_mask", "platform", "bucket_ms", "peak", "active_ms", "sessions_active", "sessions_started")


@query("SELECT count(*) AS contents, count(*) FILTER (kinds > 1) AS ambiguous, count(*) FILTER (kinds > 1) = 0 AS remap_holds FROM (SELECT p_partkey, count(DISTINCT p_type) AS kinds FROM part GROUP BY 1)")
def remap_consistency(m: Model) -> DataFrame:
    """Masks 12 and 13 are served by 4 and 5 only while a content has one video type."""
    kinds = m.contents.groupBy("content_id").agg(F.count_distinct("video_type").alias("kinds"))
    out = kinds.agg(F.count("*").alias("contents"), F.count_if(F.col("kinds") > 1).alias("ambiguous"))
    return out.withColumn("remap_holds", F.col("ambiguous") == 0)


@query(_tier((4,)) + " SELECT DISTINCT content_id, coalesce(title, '(unknown)') AS label FROM tier LEFT JOIN content USING (content_id)")
def content_labels(m: Model) -> DataFrame:
    named = m.tier((4,)).select("content_id").distinct().join(m.contents.select("content_id", F.col("title").alias("label")), "content_id", "left")
    return named.fillna({"label": "(unknown)"})


# --- functions -----------------------------------------------------------------------------------


@query("SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS yyyymmdd, CAST(strftime(o_orderdate, '%Y%m') AS INT) AS yyyymm, CASE o_orderkey % 4 WHEN 3 THEN NULL ELSE epoch_us(date_trunc('day', o_orderdate)) // 1000 END AS parsed_ms FROM orders")
def dates_best_effort(m: Model) -> DataFrame:
    k, day = F.col("o_orderkey") % 4, F.date_format("o_orderdate", "yyyy-MM-dd")
    text = F.when(k == 0, day).when(k == 1, F.concat(day, F.lit("T00:00:00Z"))).when(k == 2, F.concat(F.lit(" "), day, F.lit(" 00:00:00.000"))).otherwise("no date")
    return m.table("orders").select("o_orderkey", S.yyyymmdd(F.col("o_orderdate")).alias("yyyymmdd"), S.yyyymm(F.col("o_orderdate")).alias("yyyymm"), S.instant_ms(text).alias("parsed_ms"))


@query(EVENTS + " SELECT session_key, event_ms, event, row_version, md5(concat_ws('|', session_key::VARCHAR, event_ms::VARCHAR, event_type, event, row_version::VARCHAR)) AS fingerprint FROM ev")
def row_fingerprints(m: Model) -> DataFrame:
    return m.raw.select("session_key", "event_ms", "event", "row_version", S.fingerprint(*[F.col(c) for c in ("session_key", "event_ms", "event_type", "event", "row_version")]).alias("fingerprint"))


@query("SELECT p_partkey, CASE WHEN s < 1024 THEN printf('%.2f B', round(s, 2)) WHEN s < 1048576 THEN printf('%.2f KiB', round(s / 1024, 2)) ELSE printf('%.2f MiB', round(s / 1048576, 2)) END AS size FROM (SELECT p_partkey, CAST(p_partkey * p_partkey AS DOUBLE) AS s FROM part WHERE p_partkey < 30000)")
def readable_sizes(m: Model) -> DataFrame:
    k = F.col("p_partkey")
    return m.table("part").where("p_partkey < 30000").select("p_partkey", S.readable_size((k * k).cast("double")).alias("size"))


# --- tiles ---------------------------------------------------------------------------------------


def thousandths(ms: str, length: int) -> Column:
    """Milliseconds by a length, cut to thousandths in whole numbers, so that no rounding of a half depends on the engine."""
    return F.expr(f"({ms}) div {length // 1000}") / F.lit(1000.0)


GROUPED = (("platform", 1), ("country", 2), ("content", 4), ("video type", 8), ("category", 32))


def grouped_viewers(rollup: DataFrame, low: int, high: int, n: int) -> DataFrame:
    """grouping, member, day_ms, active_ms: of each grouping the n largest members of the window, the others as one."""
    rows = rollup.where((F.col("bucket_ms") >= low) & (F.col("bucket_ms") < high)).withColumn("day_ms", S.bucket(F.col("bucket_ms"), DAY))
    parts = []
    for name, mask in GROUPED:
        column = {"content": "content_id", "video type": "video_type"}.get(name, name)
        folded = router.top_and_other(rows.where(F.col("rollup_mask") == mask), column, "active_ms", n, "day_ms")
        parts.append(folded.select(F.lit(name).alias("grouping"), "member", "day_ms", "active_ms"))
    return reduce(DataFrame.unionByName, parts)


def _grouped_sql(n: int) -> str:
    parts = []
    for name, mask in GROUPED:
        column = {"content": "content_id", "video type": "video_type"}.get(name, name)
        top = f"(SELECT {column} FROM rollup, w WHERE rollup_mask = {mask} AND {IN_WHOLE} GROUP BY 1 ORDER BY sum(active_ms) DESC, {column} LIMIT {n})"
        parts.append(f"SELECT '{name}' AS grouping, CASE WHEN {column} IN {top} THEN CAST({column} AS VARCHAR) ELSE 'other' END AS member, bucket_ms - bucket_ms % 86400000 AS day_ms, CAST(sum(active_ms) AS BIGINT) AS active_ms FROM rollup, w WHERE rollup_mask = {mask} AND {IN_WHOLE} GROUP BY ALL")
    return _rollup((1, 2, 4, 8, 32)) + WHOLE + ", gv AS (" + " UNION ALL ".join(parts) + ")"


@query(_grouped_sql(5) + " SELECT * FROM gv")
def tile_grouped_series(m: Model) -> DataFrame:
    return grouped_viewers(m.scratch.write(m.rollup((1, 2, 4, 8, 32))), *_whole(m), 5)


@query(_grouped_sql(5) + " SELECT grouping, member, CAST(sum(active_ms) AS BIGINT) AS active_ms, round(100.0 * CAST(sum(active_ms) AS BIGINT) / CAST(sum(sum(active_ms)) OVER (PARTITION BY grouping) AS BIGINT), 6)::DOUBLE AS share_pct FROM gv GROUP BY 1, 2")
def tile_grouped_totals(m: Model) -> DataFrame:
    rows = grouped_viewers(m.scratch.write(m.rollup((1, 2, 4, 8, 32))), *_whole(m), 5)
    per = rows.groupBy("grouping", "member").agg(F.sum("active_ms").alias("active_ms"))
    whole = per.groupBy("grouping").agg(F.sum("active_ms").alias("whole"))  # one row for each of the groupings
    return per.join(F.broadcast(whole), "grouping").select("grouping", "member", "active_ms", S.share(F.col("active_ms"), F.col("whole")).alias("share_pct"))


@query(_rollup((0,)) + " SELECT bucket_ms, peak, (active_ms // 3600) / 1000.0::DOUBLE AS avg_concurrency, sessions_started, sessions_ended, sessions_active, active_ms - ending_concurrency * 3600000 AS above_ending_ms FROM rollup")
def tile_started_and_ended(m: Model) -> DataFrame:
    above = F.col("active_ms") - F.col("ending_concurrency") * HOUR
    return m.rollup((0,)).select("bucket_ms", "peak", thousandths("active_ms", HOUR).alias("avg_concurrency"), "sessions_started", "sessions_ended", "sessions_active", above.alias("above_ending_ms"))


ANSWERS = "peak", "avg_concurrency", "viewing_hours", "intervals_started", "buckets", "busiest_ms"


@query(_rollup((0,)) + ", g AS (SELECT 'hour' AS grain, bucket_ms AS grain_ms, 3600000 AS len, * FROM rollup UNION ALL SELECT 'day', bucket_ms - bucket_ms % 86400000, 86400000, * FROM rollup) SELECT grain, grain_ms, max(peak) AS peak, (CAST(sum(active_ms) AS BIGINT) // (any_value(len) // 1000)) / 1000.0::DOUBLE AS avg_concurrency, (CAST(sum(active_ms) AS BIGINT) // 3600) / 1000.0::DOUBLE AS viewing_hours, CAST(sum(sessions_started) AS BIGINT) AS intervals_started, count(*) AS buckets, arg_min(bucket_ms, -peak * 100000000000000 + bucket_ms) AS busiest_ms FROM g GROUP BY grain, grain_ms")
def benchmark_answers(m: Model) -> DataFrame:
    rows = m.scratch.write(m.rollup((0,)))

    def at(grain: str, size: int) -> DataFrame:
        out = rows.groupBy(S.bucket(F.col("bucket_ms"), size).alias("grain_ms")).agg(
            F.max("peak").alias("peak"), thousandths("sum(active_ms)", size).alias("avg_concurrency"), thousandths("sum(active_ms)", HOUR).alias("viewing_hours"),
            F.sum("sessions_started").alias("intervals_started"), F.count("*").alias("buckets"), F.min_by("bucket_ms", F.struct(-F.col("peak"), "bucket_ms")).alias("busiest_ms"),
        )
        return out.select(F.lit(grain).alias("grain"), "grain_ms", *ANSWERS)

    return at("hour", HOUR).unionByName(at("day", DAY))


@query(EVENTS + f" SELECT 'stale events' AS rule, max(event_ms) AS last_ms, max(event_ms) - max(event_ms) FILTER (signal = 'session_end') AS silent_ms, max(event_ms) - max(event_ms) FILTER (signal = 'session_end') > {STALE_MS} AS breached FROM dd")
def staleness_rule(m: Model) -> DataFrame:
    """How long the last ended session lies behind the last event, and whether that is over the limit."""
    out = m.events.agg(F.max("event_ms").alias("last_ms"), F.max(F.when(F.col("signal") == "session_end", F.col("event_ms"))).alias("ended_ms"))
    silent = F.col("last_ms") - F.col("ended_ms")
    return out.select(F.lit("stale events").alias("rule"), "last_ms", silent.alias("silent_ms"), (silent > STALE_MS).alias("breached"))


@query(EVENTS + """ SELECT * FROM (SELECT 'rows' AS gate, count(*) AS actual FROM ev UNION ALL SELECT 'no key', count(*) FROM ev WHERE session_key IS NULL UNION ALL SELECT 'no instant', count(*) FROM ev WHERE event_ms IS NULL
UNION ALL SELECT 'out of range', count(*) FROM ev WHERE event_ms < 946684800000 OR event_ms >= 4102444800000 UNION ALL SELECT 'unknown platform', count(*) FROM ev WHERE platform = 'unknown' UNION ALL SELECT 'ends', count(*) FROM ev WHERE signal = 'session_end'
UNION ALL SELECT 'copies', (SELECT count(*) FROM ev) - (SELECT count(*) FROM dd) UNION ALL SELECT 'newest version', max(row_version) FROM ev)""")
def verify_ingest(m: Model) -> DataFrame:
    """The checks of a load that need one pass over what landed, and one over what is left of it."""
    at = F.col("event_ms")
    landed = gates.gate_rows(
        m.raw,
        ("rows", F.count("*"), 0), ("no key", F.count_if(F.col("session_key").isNull()), 0), ("no instant", F.count_if(at.isNull()), 0),
        ("out of range", F.count_if((at < 946_684_800_000) | (at >= 4_102_444_800_000)), 0), ("unknown platform", F.count_if(F.col("platform") == "unknown"), 0),
        ("ends", F.count_if(F.col("signal") == "session_end"), 0), ("newest version", F.max("row_version"), 0),
    )
    return landed.unionByName(gates.gate(m.events, "copies", F.sum(F.col("copies") - 1))).drop("passed")


__all__ = ["KEYS", "registry"]
