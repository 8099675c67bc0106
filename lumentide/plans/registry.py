"""Named queries over the driver's tables, each with the SQL that an oracle runs on the same files.

A query is a function of a ``Model``, which builds the layers that it asks for; nothing is
computed before the result is collected but the observation horizon, a single number, and the
tables of queries that read a layer more than once, which are written first.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumentide.functions import scalars as S
from lumentide.operators import boundaries, corrections, live, sessions, tiers
from lumentide.operators.boundaries import KEYS
from lumentide.plans import gates, profile, router
from lumentide.policy import DAY, DELTA_MASKS, HOUR, ROLLUP_MASKS, TIER_MASKS, WIDE, Policy
from lumentide.sources import binding
from lumentide.stored import Scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


@dataclass(frozen=True)
class Build:
    intervals: DataFrame
    points: DataFrame
    tier: DataFrame


class Model:
    """The layers over one folder of tables."""

    def __init__(self, spark: SparkSession, sf_dir: str, policy: Policy = WIDE):
        self.spark, self.sf_dir, self.policy = spark, sf_dir, policy

    def table(self, name: str) -> DataFrame:
        return binding.read(self.spark, self.sf_dir, name)

    @cached_property
    def raw(self) -> DataFrame:
        return binding.clean_events(self.spark, self.sf_dir)

    @cached_property
    def events(self) -> DataFrame:
        return sessions.dedup_latest(self.raw)

    @cached_property
    def contents(self) -> DataFrame:
        return binding.contents(self.spark, self.sf_dir)

    @cached_property
    def horizon(self) -> int:
        """Of the raw scan: neither copies nor dimensions matter to it."""
        return self.table("events").agg(F.max(F.unix_millis(F.col("ts").cast("timestamp")))).first()[0] or 0

    @cached_property
    def as_of(self) -> int:
        return self.horizon + self.policy.timeout_ms

    @cached_property
    def clipped(self) -> DataFrame:
        return sessions.clipped_events(self.events, self.policy, self.as_of)

    @cached_property
    def folded(self) -> DataFrame:
        return sessions.state_fold(sessions.instants(self.clipped))

    @cached_property
    def leased(self) -> DataFrame:
        return sessions.lease(self.folded, self.policy, self.as_of)

    @cached_property
    def bare(self) -> DataFrame:
        return sessions.active_intervals(self.events, self.policy, self.as_of)

    @cached_property
    def intervals(self) -> DataFrame:
        return sessions.with_content(self.bare, self.contents)

    def fan(self, masks: tuple[int, ...] = TIER_MASKS, *more: str) -> DataFrame:
        return boundaries.fan_out(self.intervals, masks, *more)

    def points(self, masks: tuple[int, ...] = TIER_MASKS) -> DataFrame:
        return boundaries.deltas(self.fan(masks))

    @cached_property
    def scratch(self) -> Scratch:
        return Scratch(self.spark, "build")

    @cached_property
    def kept(self) -> DataFrame:
        """The intervals, written: for what reads them several times."""
        return self.scratch.write(self.intervals)

    def build(self) -> Build:
        """Intervals, boundaries and tier of the tier's masks, written once; the latter two in folders by mask."""
        fanned = boundaries.fan_out(self.kept, TIER_MASKS)
        points = self.scratch.write(boundaries.deltas(fanned), "rollup_mask")
        return Build(self.kept, points, self.scratch.write(tiers.dense_tier(fanned, points, self.policy.bucket_ms), "rollup_mask"))

    def total(self) -> DataFrame:
        """Boundaries of the total alone, without dimensions."""
        return boundaries.deltas(self.bare.withColumn("rollup_mask", F.lit(0)), ("rollup_mask",))

    def levels(self) -> DataFrame:
        return boundaries.curve(self.total(), ("rollup_mask",))

    def tier(self, masks: tuple[int, ...] = TIER_MASKS) -> DataFrame:
        fanned = boundaries.fan_out(self.kept, masks)
        return tiers.dense_tier(fanned, boundaries.deltas(fanned), self.policy.bucket_ms)

    def rollup(self, masks: tuple[int, ...] = ROLLUP_MASKS) -> DataFrame:
        return tiers.minute_rollup(boundaries.fan_out(self.kept, masks, "app_version", "category"), self.policy.bucket_ms)

    def day(self, back: int) -> int:
        """Midnight so many days before that of the horizon."""
        return self.horizon - self.horizon % DAY - back * DAY


def query(sql: str | None = None, policy: Policy = WIDE):
    """Registers a function of a Model under its name."""

    def take(f: Callable[[Model], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Model(spark, sf_dir, policy))
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return take


# --- the oracle's chain --------------------------------------------------------------------------

EVENTS = "WITH " + binding.SQL
SESSIONS = EVENTS + sessions.SQL.format(timeout=WIDE.timeout_ms)
NARROW = EVENTS + sessions.SQL.format(timeout=120_000)


def _points(masks: tuple[int, ...]) -> str:
    return SESSIONS + boundaries.SQL.format(masks=list(masks))


def _tier(masks: tuple[int, ...] = TIER_MASKS) -> str:
    return _points(masks) + tiers.SQL.format(size=HOUR)


RU_KEYS = "rollup_mask, content_id, platform, country, app_version, video_type, category"


def _rollup(masks: tuple[int, ...] = ROLLUP_MASKS, keys: str = RU_KEYS) -> str:
    return _tier(masks) + tiers.ROLLUP_SQL.format(size=HOUR, keys=keys)


KEY_SQL = "rollup_mask, platform, country, content_id, video_type"
DAYS_BACK = "(SELECT h - h % 86400000 - {}::BIGINT * 86400000 FROM hz)".format
CURVE0 = """, c0 AS (SELECT t AS boundary_ms, CAST(sum(sum(d)) OVER (ORDER BY t ROWS UNBOUNDED PRECEDING) AS BIGINT) AS level FROM (SELECT start_ms AS t, 1 AS d FROM iv UNION ALL SELECT end_ms, -1 FROM iv) GROUP BY t)
, s0 AS (SELECT boundary_ms AS start_ms, lead(boundary_ms) OVER (ORDER BY boundary_ms) AS end_ms, level FROM c0)"""

# --- events --------------------------------------------------------------------------------------


@query(EVENTS + " SELECT session_key, event_ms, row_version, event_type, event, signal, event IN ('network-activity', 'buffer-health', 'video-resize') AS is_periodic_ping FROM ev")
def classify_signals(m: Model) -> DataFrame:
    return m.raw.select("session_key", "event_ms", "row_version", "event_type", "event", "signal", "is_periodic_ping")


@query(EVENTS + " SELECT signal, count(*) AS events, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS share_pct FROM ev GROUP BY signal")
def signal_share(m: Model) -> DataFrame:
    return m.raw.groupBy("signal").agg(F.count("*").alias("events")).withColumn("share_pct", F.round(100.0 * F.col("events") / F.sum("events").over(Window.partitionBy()), 6))


@query(EVENTS + " SELECT session_key, event_ms, event_type, event, row_version, content_id, signal FROM dd")
def dedup_latest(m: Model) -> DataFrame:
    return m.events.select("session_key", "event_ms", "event_type", "event", "row_version", "content_id", "signal")


@query(EVENTS + " SELECT session_key, event_ms, event_type, event, count(DISTINCT content_id) AS kinds FROM ev GROUP BY ALL HAVING count(DISTINCT content_id) > 1")
def dedup_conflicts(m: Model) -> DataFrame:
    return m.raw.groupBy(*sessions.EVENT_KEY).agg(F.count_distinct("content_id").alias("kinds")).where("kinds > 1")


@query(EVENTS + ", k AS (SELECT count(*) AS n, count(DISTINCT content_id) AS kinds FROM ev GROUP BY session_key, event_ms, event_type, event) SELECT count(*) AS keys, CAST(sum(n - 1) AS BIGINT) AS copies, max(n) AS most, count(*) FILTER (kinds > 1) AS conflicts FROM k")
def duplicate_multiplicity(m: Model) -> DataFrame:
    return profile.multiplicity(m.raw)


@query(EVENTS + " SELECT (SELECT count(*) FROM ev) AS landed, (SELECT count(*) FROM dd) AS kept, round(100.0 * ((SELECT count(*) FROM ev) - (SELECT count(*) FROM dd)) / (SELECT count(*) FROM ev), 6) AS collapsed_pct")
def dedup_collapse(m: Model) -> DataFrame:
    return m.events.agg(F.sum("copies").alias("landed"), F.count("*").alias("kept")).withColumn("collapsed_pct", F.round(100.0 * (F.col("landed") - F.col("kept")) / F.col("landed"), 6))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'unknown' ELSE lower(split_part(trim(l), '-', 1)) END AS language FROM (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN ' UND' WHEN 1 THEN 'EN-us ' WHEN 2 THEN ' off' ELSE lower(o_orderpriority) END AS l FROM orders)""")
def normalize_language(m: Model) -> DataFrame:
    k = F.col("o_orderkey") % 4
    dirty = F.when(k == 0, " UND").when(k == 1, "EN-us ").when(k == 2, " off").otherwise(F.lower("o_orderpriority"))
    return m.table("orders").select("o_orderkey", S.language(dirty).alias("language"))


@query("""SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'unknown' WHEN 1 THEN '1920x1080' ELSE lower(replace(trim(o_orderpriority), ' ', '')) END AS resolution, CASE WHEN o_orderkey % 5 = 0 THEN 'unknown' ELSE o_orderstatus END AS player_version FROM orders""")
def normalize_resolution(m: Model) -> DataFrame:
    k = F.col("o_orderkey") % 3
    dirty = F.when(k == 0, " Auto-Auto").when(k == 1, " 1920 X 1080 ").otherwise(F.col("o_orderpriority"))
    version = F.when(F.col("o_orderkey") % 5 == 0, "  ").otherwise(F.concat(F.lit(" "), "o_orderstatus"))
    return m.table("orders").select("o_orderkey", S.resolution(dirty).alias("resolution"), S.player_version(version).alias("player_version"))


@query("""SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN CAST(c_custkey AS BIGINT) WHEN 1 THEN -CAST(c_custkey AS BIGINT) WHEN 2 THEN -CAST(c_custkey AS BIGINT) ELSE NULL END AS content_id FROM customer""")
def validate_content_id(m: Model) -> DataFrame:
    k, n = F.col("c_custkey") % 4, F.col("c_custkey").cast("decimal(20,0)")
    text = F.when(k == 0, n.cast("string")).when(k == 1, F.concat(F.lit(" -"), n.cast("string"))).when(k == 2, (F.lit("18446744073709551616").cast("decimal(20,0)") - n).cast("string")).otherwise(F.concat(F.lit("x"), n.cast("string")))
    return m.table("customer").select("c_custkey", S.content_id(text).alias("content_id"))


@query("""SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN epoch_us(o_orderdate) // 1000 WHEN 1 THEN epoch_us(o_orderdate) // 1000 ELSE NULL END AS event_ms FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01' OR o_orderkey % 5 > 1
UNION ALL SELECT o_orderkey, NULL FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01' AND o_orderkey % 5 <= 1""")
def validate_epoch_ms(m: Model) -> DataFrame:
    ms, k = F.unix_millis(F.col("o_orderdate").cast("timestamp")).cast("string"), F.col("o_orderkey") % 5
    text = F.when(k == 0, ms).when(k == 1, F.concat(ms, F.lit(".0"))).when(k == 2, F.concat(ms, F.lit(".5"))).when(k == 3, F.concat(ms, F.lit("000"))).otherwise(F.lit(""))
    return m.table("orders").select("o_orderkey", S.epoch_ms(text).alias("event_ms"))


@query("""SELECT CASE WHEN c_custkey % 7 = 0 THEN 'bad_session_id' WHEN c_custkey % 7 = 1 THEN 'bad_user_id' WHEN c_custkey % 7 = 2 THEN 'bad_content_id' WHEN c_custkey % 7 = 3 THEN 'bad_timestamp' ELSE 'good' END AS reason, count(*) AS n FROM customer GROUP BY 1""")
def quarantine_reasons(m: Model) -> DataFrame:
    from lumentide.sources.readers import validate

    k = F.col("c_custkey") % 7
    good = F.sha2(F.col("c_custkey").cast("string").cast("binary"), 256)
    rows = m.table("customer").select(
        F.when(k == 0, "short").otherwise(good).alias("video_session_id"), F.when(k == 1, F.concat(F.lit("g"), F.substring(good, 2, 63))).otherwise(good).alias("user_id"),
        F.when(k == 2, "").otherwise(F.col("c_custkey").cast("string")).alias("content_id"), F.when(k == 3, "1785062007").otherwise("1785062007336").alias("event_timestamp"),
    )
    checked = validate(rows)
    return checked.groupBy(F.coalesce("reject_reason", F.lit("good")).alias("reason")).agg(F.count("*").alias("n"))


@query(EVENTS + " SELECT session_key, event_ms, (event_ms << 20) + (row_version % 1000) AS version FROM raw")
def row_versions(m: Model) -> DataFrame:
    return m.raw.where("row_version < 1000000000").select("session_key", "event_ms", S.row_version(F.col("event_ms"), F.col("row_version") % 1000).alias("version"))


# --- sessions ------------------------------------------------------------------------------------


@query(SESSIONS + " SELECT a.session_key, coalesce(first_start, first_event) AS lifecycle_start, first_start IS NOT NULL AS has_start, first_event, last_event, terminal_end, has_play_signal, has_fg_signal, user_key, content_id, platform, country, app_version FROM an a JOIN fd USING (session_key)")
def session_anchors(m: Model) -> DataFrame:
    return sessions.anchors(m.events)


@query(SESSIONS + " SELECT session_key, first_event FROM an WHERE first_start IS NULL")
def boundary_sessions(m: Model) -> DataFrame:
    return sessions.anchors(m.events).where("not has_start").select("session_key", "first_event")


@query(SESSIONS + " SELECT session_key, event_ms, starts, ends, hides, shows, stops, plays, lives FROM ins")
def instant_flags(m: Model) -> DataFrame:
    return sessions.instants(m.clipped).select("session_key", "event_ms", "starts", "ends", "hides", "shows", "stops", "plays", "lives")


@query(SESSIONS + " SELECT session_key, event_ms, started, ended, CAST(fg_state AS INT) AS fg_state, CAST(play_state AS INT) AS play_state, CAST(fg_setter AS INT) AS fg_setter, CAST(play_setter AS INT) AS play_setter FROM st")
def state_fold(m: Model) -> DataFrame:
    return m.folded.select("session_key", "event_ms", "started", "ended", *[F.col(c).cast("int").alias(c) for c in ("fg_state", "play_state", "fg_setter", "play_setter")])


@query(SESSIONS + " SELECT session_key, event_ms, is_on, is_on AND lives AS eligible, last_eligible, next_ms FROM ls")
def lease_state(m: Model) -> DataFrame:
    return m.leased.select("session_key", "event_ms", F.col("on").alias("is_on"), "eligible", "last_eligible", "next_ms")


@query(SESSIONS + " SELECT session_key, start_ms, end_ms FROM sg")
def segments(m: Model) -> DataFrame:
    return sessions.segments(m.leased, m.policy).select("session_key", "start_ms", "end_ms")


INTERVAL_COLUMNS = ("session_key", "interval_index", "start_ms", "end_ms", "lifecycle_start", "user_key", "content_id", "platform", "country", "app_version", "video_type", "category")


@query(SESSIONS + f" SELECT {', '.join(INTERVAL_COLUMNS)} FROM iv")
def active_intervals(m: Model) -> DataFrame:
    return m.intervals.select(*INTERVAL_COLUMNS)


@query(NARROW + " SELECT session_key, interval_index, start_ms, end_ms FROM iv0", policy=Policy())
def active_intervals_120s(m: Model) -> DataFrame:
    return m.bare.select("session_key", "interval_index", "start_ms", "end_ms")


@query(SESSIONS + " SELECT session_key, interval_index, v AS clip_variant, start_ms, CASE WHEN v = 'clipped' THEN least(end_ms, (SELECT h FROM hz)) ELSE end_ms END AS end_ms FROM iv0, (SELECT unnest(['unclipped', 'clipped']) AS v) WHERE v = 'unclipped' OR start_ms < (SELECT h FROM hz)")
def active_intervals_clipped(m: Model) -> DataFrame:
    return sessions.clip_variants(m.bare, m.horizon).select("session_key", "interval_index", "clip_variant", "start_ms", "end_ms")


@query(SESSIONS + " SELECT s.session_key, count(start_ms) AS n, coalesce(string_agg(start_ms || '-' || end_ms, ',' ORDER BY start_ms), '') AS intervals FROM (SELECT DISTINCT session_key FROM dd) s LEFT JOIN iv0 USING (session_key) GROUP BY s.session_key")
def interval_arrays(m: Model) -> DataFrame:
    text = F.array_join(F.transform("intervals", lambda x: F.concat_ws("-", x["start_ms"].cast("string"), x["end_ms"].cast("string"))), ",")
    return sessions.interval_arrays(m.events, m.bare).select("session_key", F.size("intervals").cast("long").alias("n"), text.alias("intervals"))


@query(SESSIONS + " SELECT session_key, CASE WHEN session_key % 3 = 0 THEN 2 ELSE 1 END AS state_revision, start_ms, end_ms FROM iv0 WHERE session_key % 5 <> 0")
def current_revision(m: Model) -> DataFrame:
    cols = ("session_key", "state_revision", "start_ms", "end_ms")
    first = m.bare.withColumn("state_revision", F.lit(1)).select(*cols)
    second = m.bare.where("session_key % 3 = 0 and session_key % 5 <> 0").withColumn("state_revision", F.lit(2)).select(*cols)
    gone = m.bare.where("session_key % 5 = 0").select("session_key", F.lit(3).alias("state_revision"), F.lit(None).cast("long").alias("start_ms"), F.lit(None).cast("long").alias("end_ms")).distinct()
    return sessions.current_revision(first.unionByName(second).unionByName(gone)).select(*cols)


# --- boundaries ----------------------------------------------------------------------------------


@query(_points(DELTA_MASKS) + f" SELECT {KEY_SQL}, boundary_ms, opens, closes FROM dl")
def boundary_deltas(m: Model) -> DataFrame:
    return m.points(DELTA_MASKS)


@query(_points(TIER_MASKS) + f" SELECT {KEY_SQL}, boundary_ms - boundary_ms % 3600000 AS bucket_ms, CAST(sum(opens) AS BIGINT) AS opens, CAST(sum(closes) AS BIGINT) AS closes, count(*) AS n_deltas FROM dl GROUP BY ALL")
def bucket_net(m: Model) -> DataFrame:
    return boundaries.bucket_net(m.points(), HOUR)


ANCHORS = f""", dn AS (SELECT {KEY_SQL}, boundary_ms - boundary_ms % 86400000 AS day_ms, sum(opens - closes) AS net FROM dl GROUP BY ALL)
, sp AS (SELECT {KEY_SQL}, unnest(generate_series(min(day_ms), max(day_ms) + 86400000, 86400000)) AS day_ms FROM dn GROUP BY {KEY_SQL})
, da AS (SELECT sp.*, CAST(coalesce(sum(net) OVER (PARTITION BY {KEY_SQL} ORDER BY day_ms ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS level FROM sp LEFT JOIN dn USING ({KEY_SQL}, day_ms))"""


@query(_points((0, 1, 8)) + ANCHORS + f" SELECT {KEY_SQL}, day_ms, level FROM da")
def day_anchor(m: Model) -> DataFrame:
    return boundaries.day_anchors(m.points((0, 1, 8)))


@query(_points((0, 1)) + f""", w AS (SELECT {DAYS_BACK(20)} + 6 * 3600000 AS lo, {DAYS_BACK(20)} + 18 * 3600000 AS hi)
, k AS (SELECT DISTINCT {KEY_SQL} FROM cv, w WHERE boundary_ms < hi)
, e AS (SELECT {KEY_SQL}, arg_max(level, boundary_ms) AS level FROM cv, w WHERE boundary_ms <= lo GROUP BY ALL)
, i AS (SELECT {KEY_SQL}, max(level) AS level FROM cv, w WHERE boundary_ms > lo AND boundary_ms < hi GROUP BY ALL)
SELECT {KEY_SQL}, greatest(coalesce(e.level, 0), coalesce(i.level, 0)) AS peak FROM k LEFT JOIN e USING ({KEY_SQL}) LEFT JOIN i USING ({KEY_SQL}) WHERE greatest(coalesce(e.level, 0), coalesce(i.level, 0)) > 0""")
def anchored_window_peak(m: Model) -> DataFrame:
    low = m.day(20) + 6 * HOUR
    points = m.scratch.write(m.points((0, 1)))
    return boundaries.window_peak(points, boundaries.day_anchors(points), low, low + 12 * HOUR).where("peak > 0")


@query(SESSIONS + CURVE0 + " SELECT boundary_ms, level FROM c0")
def exact_curve(m: Model) -> DataFrame:
    return m.levels().select("boundary_ms", "level")


@query(SESSIONS + CURVE0 + " SELECT max(level) AS peak, min(boundary_ms) FILTER (level = (SELECT max(level) FROM c0)) AS peak_ms FROM c0")
def peak_unbounded(m: Model) -> DataFrame:
    return boundaries.peak(m.levels())


@query(_points((1,)) + " SELECT platform, max(level) AS peak, arg_min(boundary_ms, (-level) * 100000000000000 + boundary_ms) AS peak_ms FROM cv GROUP BY platform")
def peak_by_platform(m: Model) -> DataFrame:
    return boundaries.peak(boundaries.curve(m.points((1,))), "platform")


@query(SESSIONS + f", w AS (SELECT {DAYS_BACK(31)} AS lo, {DAYS_BACK(-1)} AS hi) SELECT CAST(sum(least(end_ms, hi) - greatest(start_ms, lo)) AS BIGINT) AS active_ms, round(CAST(sum(least(end_ms, hi) - greatest(start_ms, lo)) AS BIGINT) / any_value(hi - lo), 6) AS avg_concurrency FROM iv, w WHERE start_ms < hi AND end_ms > lo")
def time_weighted_avg(m: Model) -> DataFrame:
    return boundaries.average(m.bare, m.day(31), m.day(-1))


BUCKETS = """, w AS (SELECT {lo} AS lo, {hi} AS hi)
, b AS (SELECT unnest(generate_series(lo - lo % 3600000, hi - 1, 3600000)) AS bucket_ms, lo, hi FROM w)
, x AS (SELECT b.bucket_ms, max(level) AS peak, CAST(sum(level * (least(s.end_ms, bucket_ms + 3600000, hi) - greatest(s.start_ms, bucket_ms, lo))) AS BIGINT) AS active_ms
  FROM b JOIN s0 s ON s.start_ms < least(bucket_ms + 3600000, hi) AND s.end_ms > greatest(bucket_ms, lo) WHERE level > 0 GROUP BY b.bucket_ms)
SELECT bucket_ms, coalesce(peak, 0) AS peak, coalesce(active_ms, 0) AS active_ms, round(coalesce(active_ms, 0) / (least(bucket_ms + 3600000, hi) - greatest(bucket_ms, lo)), 6) AS avg_concurrency FROM b LEFT JOIN x USING (bucket_ms)"""


@query(SESSIONS + CURVE0 + BUCKETS.format(lo=DAYS_BACK(30) + " + 1234567", hi=DAYS_BACK(26) + " + 7654321"))
def exact_bucket_metrics(m: Model) -> DataFrame:
    return boundaries.bucket_metrics(m.total(), m.day(30) + 1_234_567, m.day(26) + 7_654_321, HOUR)


@query(SESSIONS + CURVE0 + ", x AS (SELECT unnest(generate_series(start_ms - start_ms % 3600000, end_ms - 1 - (end_ms - 1) % 3600000, 3600000)) AS bucket_ms, * FROM s0 WHERE level > 0) SELECT bucket_ms, max(level) AS peak, CAST(sum(level * (least(end_ms, bucket_ms + 3600000) - greatest(start_ms, bucket_ms))) AS BIGINT) AS active_ms FROM x GROUP BY bucket_ms")
def minute_series_theta(m: Model) -> DataFrame:
    parts = boundaries.steps(m.total(), ("rollup_mask",)).where("level > 0")
    return boundaries.spread(parts, HOUR).groupBy("bucket_ms").agg(F.max("level").alias("peak"), F.sum(F.col("level") * F.col("overlap_ms")).alias("active_ms"))


# --- tiers ---------------------------------------------------------------------------------------

TIER_COLUMNS = "rollup_mask, platform, country, content_id, video_type, bucket_ms, peak, active_ms, ending_concurrency, boundary_points"


@query(_tier() + f" SELECT {TIER_COLUMNS} FROM tier")
def bucket_tier(m: Model) -> DataFrame:
    return m.tier()


@query(_tier((5,)) + " SELECT t.platform, t.country, t.content_id, t.bucket_ms, t.peak, t.active_ms, t.ending_concurrency, t.boundary_points, 13 AS rollup_mask, coalesce(nullif(c.video_type, ''), '__unknown__') AS video_type FROM tier t LEFT JOIN content c USING (content_id)")
def mask13_derived(m: Model) -> DataFrame:
    return tiers.derived_mask(m.tier((5,)), m.contents)


@query(_tier((0, 1)) + f" SELECT {TIER_COLUMNS}, 2 AS generation FROM tier")
def generation_current(m: Model) -> DataFrame:
    t = m.tier((0, 1))
    old = t.withColumn("peak", F.col("peak") + 1).withColumn("generation", F.lit(1))
    return tiers.current_generation(old.unionByName(t.withColumn("generation", F.lit(2))))


GRAIN = " SELECT {keys}, bucket_ms - bucket_ms % {size} AS grain_ms, max(peak) AS peak, CAST(sum(active_ms) AS BIGINT) AS active_ms, arg_max(ending_concurrency, bucket_ms) AS ending_concurrency, count(*) AS buckets FROM tier GROUP BY ALL"


@query(_tier((0, 1, 2)) + GRAIN.format(keys=KEY_SQL, size=6 * HOUR))
def grain_hour(m: Model) -> DataFrame:
    return tiers.coarser(m.tier((0, 1, 2)), 6 * HOUR)


@query(_tier((0, 1, 2)) + GRAIN.format(keys=KEY_SQL, size=DAY))
def grain_day(m: Model) -> DataFrame:
    return tiers.coarser(m.tier((0, 1, 2)), DAY)


LIVE_KEYS = "rollup_mask, content_id"
LIVE = SESSIONS.replace("), iv AS (", "), iv_all AS (") + f""", iv AS (SELECT * REPLACE (greatest(start_ms, {DAYS_BACK(3)}) AS start_ms, least(end_ms, (SELECT h FROM hz)) AS end_ms) FROM iv_all WHERE start_ms < (SELECT h FROM hz) AND end_ms > {DAYS_BACK(3)})""" + boundaries.SQL.format(masks=[0, 4]) + tiers.SQL.format(size=600_000) + tiers.ROLLUP_SQL.format(size=600_000, keys=LIVE_KEYS)


@query(LIVE + " SELECT rollup_mask, content_id, bucket_ms, peak, ending_concurrency, active_ms FROM rollup")
def rollup_live(m: Model) -> DataFrame:
    return tiers.live_rollup(m.fan((0, 4)), m.day(3), m.horizon, 600_000)


@query(_rollup() + f" SELECT {RU_KEYS}, bucket_ms, peak, ending_concurrency, active_ms, sessions_active, sessions_started, sessions_ended, CASE rollup_mask WHEN 0 THEN 'total' WHEN 1 THEN 'platform' WHEN 2 THEN 'country' WHEN 3 THEN 'platform + country' WHEN 4 THEN 'content' WHEN 5 THEN 'platform + content' WHEN 8 THEN 'video type' WHEN 9 THEN 'platform + video type' WHEN 16 THEN 'app version' WHEN 32 THEN 'category' ELSE 'all dimensions' END AS grouping FROM rollup")
def rollup_minute_masks(m: Model) -> DataFrame:
    return m.rollup()


@query(_tier((0,)) + " SELECT bucket_ms, count(DISTINCT session_key) AS sessions, CAST(sum(least(end_ms, bucket_ms + 3600000) - greatest(start_ms, bucket_ms)) AS BIGINT) AS active_ms FROM sp GROUP BY bucket_ms")
def overlap_minute_counts(m: Model) -> DataFrame:
    return tiers.overlap_counts(m.bare, HOUR)


# --- users and corrections -----------------------------------------------------------------------

USERS = f""", um AS (SELECT *, coalesce(start_ms > max(end_ms) OVER (PARTITION BY user_key, {KEY_SQL} ORDER BY start_ms, end_ms ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS opens FROM fan)
, un AS (SELECT *, CAST(sum(opens::INT) OVER (PARTITION BY user_key, {KEY_SQL} ORDER BY start_ms, end_ms ROWS UNBOUNDED PRECEDING) AS BIGINT) AS interval_index FROM um)
, ui AS (SELECT user_key, {KEY_SQL}, interval_index, min(start_ms) AS start_ms, max(end_ms) AS end_ms FROM un GROUP BY ALL)"""


@query(_points((0, 1)) + USERS + f" SELECT user_key, {KEY_SQL}, interval_index, start_ms, end_ms FROM ui")
def user_intervals(m: Model) -> DataFrame:
    return corrections.user_intervals(m.fan((0, 1)))


@query(_points((0, 1)) + USERS + f", l AS (SELECT {KEY_SQL}, t, sum(sum(d)) OVER (PARTITION BY {KEY_SQL} ORDER BY t ROWS UNBOUNDED PRECEDING) AS level FROM (SELECT {KEY_SQL}, start_ms AS t, 1 AS d FROM ui UNION ALL SELECT {KEY_SQL}, end_ms, -1 FROM ui) GROUP BY {KEY_SQL}, t) SELECT {KEY_SQL}, CAST(max(level) AS BIGINT) AS peak, arg_min(t, CAST(-level AS BIGINT) * 100000000000000 + t) AS peak_ms FROM l GROUP BY ALL")
def user_concurrency(m: Model) -> DataFrame:
    return boundaries.peak(boundaries.curve(boundaries.deltas(corrections.user_intervals(m.fan((0, 1))))), *KEYS)


def _late_versions(m: Model) -> tuple[DataFrame, DataFrame]:
    """(new, old): intervals with all events, and without a late tenth of the pauses and resumes."""
    early = m.events.where("not (signal in ('pause', 'resume') and row_version % 10 = 3)")
    old = sessions.with_content(sessions.active_intervals(early, m.policy, m.as_of), m.contents)
    return m.fan((0, 1)), boundaries.fan_out(old, (0, 1))


OLD_EVENTS = EVENTS.replace("QUALIFY row_number() OVER (PARTITION BY session_key, event_ms, event_type, event ORDER BY row_version DESC) = 1", "QUALIFY row_number() OVER (PARTITION BY session_key, event_ms, event_type, event ORDER BY row_version DESC) = 1 AND NOT (signal IN ('pause', 'resume') AND row_version % 10 = 3)")
OLD = OLD_EVENTS + sessions.SQL.format(timeout=WIDE.timeout_ms).replace("SELECT max(event_ms) AS h, max(event_ms) + 43200000 AS as_of FROM dd", "SELECT max(event_ms) AS h, max(event_ms) + 43200000 AS as_of FROM ev") + boundaries.SQL.format(masks=[0, 1])


def _nested(chain: str, prefix: str) -> str:
    """A chain as one CTE that gives its fanned intervals."""
    return f"{prefix} AS ({chain} SELECT {KEY_SQL}, session_key, start_ms, end_ms FROM fan)"


SIGNED = f"WITH {_nested(_points((0, 1)), 'nw')}, {_nested(OLD, 'od')}, ch AS (SELECT session_key, {KEY_SQL}, t AS boundary_ms, CAST(sum(d) AS BIGINT) AS delta FROM (SELECT session_key, {KEY_SQL}, start_ms AS t, 1 AS d FROM nw UNION ALL SELECT session_key, {KEY_SQL}, end_ms, -1 FROM nw UNION ALL SELECT session_key, {KEY_SQL}, start_ms, -1 FROM od UNION ALL SELECT session_key, {KEY_SQL}, end_ms, 1 FROM od) GROUP BY ALL HAVING sum(d) <> 0)"


@query(SIGNED + f" SELECT session_key, {KEY_SQL}, boundary_ms, delta FROM ch")
def correction_diff(m: Model) -> DataFrame:
    return corrections.correction(*_late_versions(m))


@query("SELECT 'corrected equals rebuilt' AS gate, CAST(0 AS BIGINT) AS actual, true AS passed")
def correction_converges(m: Model) -> DataFrame:
    new, old = _late_versions(m)
    fixed = corrections.net_points(corrections.signed_boundaries(old, 1).unionByName(corrections.correction(new, old)))
    rebuilt = corrections.net_points(corrections.signed_boundaries(new, 1))
    return gates.gate(corrections.difference(fixed, rebuilt, (*KEYS, "boundary_ms"), "delta"), "corrected equals rebuilt", F.count("*"))


@query(SIGNED + f" SELECT {KEY_SQL}, boundary_ms, CAST(sum(delta) AS BIGINT) AS delta FROM ch GROUP BY ALL HAVING sum(delta) <> 0")
def ledger_net_points(m: Model) -> DataFrame:
    return corrections.net_points(corrections.correction(*_late_versions(m)))


@query(SESSIONS + " SELECT session_key, interval_index, d AS service_day_ms, greatest(start_ms, d) AS start_ms, least(end_ms, d + 86400000) AS end_ms FROM (SELECT *, unnest(generate_series(start_ms - start_ms % 86400000, end_ms - 1 - (end_ms - 1) % 86400000, 86400000)) AS d FROM iv0)")
def day_split_endpoints(m: Model) -> DataFrame:
    return corrections.day_split(m.bare.select("session_key", "interval_index", "start_ms", "end_ms"))


@query(f"WITH {_nested(_points((0,)), 'nw')}, {_nested(OLD.replace('[0, 1]', '[0]'), 'od')} SELECT session_key, start_ms, end_ms FROM nw WHERE session_key % 2 = 0 UNION ALL SELECT session_key, start_ms, end_ms FROM od WHERE session_key % 2 <> 0")
def overlay_sessions(m: Model) -> DataFrame:
    new, old = (x.where("rollup_mask = 0").select("session_key", "start_ms", "end_ms") for x in _late_versions(m))
    touched = m.events.where("session_key % 2 = 0").select("session_key").distinct()
    return corrections.overlay(old, new.where("session_key % 2 = 0"), touched)


@query(SESSIONS + " SELECT DISTINCT session_key FROM iv0 WHERE session_key % 4 = 0 AND session_key NOT IN (SELECT session_key FROM iv0 WHERE end_ms - start_ms > 43200000)")
def tombstones(m: Model) -> DataFrame:
    touched = m.events.where("session_key % 4 = 0").select("session_key").distinct()
    return corrections.tombstones(m.bare, m.bare.where("end_ms - start_ms > 43200000"), touched)


@query(EVENTS + ", q AS (SELECT session_key, min(event_ms) AS since_ms, max(event_ms) AS until_ms FROM dd GROUP BY 1) SELECT session_key, since_ms, until_ms FROM q WHERE NOT (session_key % 3 = 0) AND NOT (session_key % 5 = 0) ORDER BY since_ms, session_key LIMIT 20")
def touched_workset(m: Model) -> DataFrame:
    dirty = m.events.select("session_key", F.col("event_ms").alias("dirty_ms"))
    applied = m.events.where("session_key % 3 = 0").groupBy("session_key").agg(F.max("event_ms").alias("applied_ms"))
    return corrections.workset(dirty, applied, m.events.where("session_key % 5 = 0"), 20)


# --- live ----------------------------------------------------------------------------------------

LIVE_STATE = EVENTS + """, lx AS (SELECT session_key, max(event_ms) AS last_event_ms, bool_or(signal = 'session_end') AS terminated FROM dd GROUP BY 1)
, f1 AS (SELECT session_key, event_ms, max(CASE WHEN signal IN ('background', 'session_end') THEN 1 ELSE 0 END) AS stop FROM dd WHERE signal IN ('session_start', 'foreground', 'play', 'resume', 'liveness', 'background', 'session_end') GROUP BY ALL)
, f2 AS (SELECT session_key, 1 - arg_max(stop, event_ms) AS fg FROM f1 GROUP BY 1)
, p1 AS (SELECT session_key, event_ms, max(CASE WHEN signal IN ('pause', 'error', 'session_end') THEN 1 ELSE 0 END) AS stop FROM dd WHERE signal IN ('play', 'resume', 'pause', 'error', 'session_end') GROUP BY ALL)
, p2 AS (SELECT session_key, 1 - arg_max(stop, event_ms) AS play FROM p1 GROUP BY 1)
, d1 AS (SELECT session_key, platform, country, content_id FROM dd QUALIFY row_number() OVER (PARTITION BY session_key ORDER BY event_ms, row_version) = 1)
, ls AS (SELECT lx.*, CAST(coalesce(fg, 0) AS INT) AS fg, CAST(coalesce(play, 0) AS INT) AS play, platform, country, content_id FROM lx LEFT JOIN f2 USING (session_key) LEFT JOIN p2 USING (session_key) JOIN d1 USING (session_key))
, hz AS (SELECT max(event_ms) AS h FROM dd), lv AS (SELECT ls.* FROM ls, hz WHERE last_event_ms > h - 43200000 AND NOT terminated)"""
COUNTS = "count(*) FILTER (fg = 1 AND play = 1) AS live_viewers, count(*) FILTER (fg = 1) AS live_incl_paused"


def _live(m: Model) -> DataFrame:
    return live.live_now(live.live_state(m.events), m.horizon, m.policy.timeout_ms)


@query(LIVE_STATE + " SELECT * FROM ls")
def live_session_state(m: Model) -> DataFrame:
    return live.live_state(m.events).withColumn("fg", F.col("fg").cast("int")).withColumn("play", F.col("play").cast("int"))


@query(LIVE_STATE + f" SELECT {COUNTS} FROM lv")
def live_now(m: Model) -> DataFrame:
    return live.live_counts(_live(m))


@query(LIVE_STATE + f" SELECT platform, {COUNTS} FROM lv GROUP BY platform")
def live_by_platform(m: Model) -> DataFrame:
    return live.live_counts(_live(m), "platform")


@query(LIVE_STATE + " SELECT content_id, coalesce(title, '(unknown)') AS title, coalesce(video_type, 'unknown') AS video_type, count(*) FILTER (fg = 1 AND play = 1) AS live_viewers FROM lv LEFT JOIN content USING (content_id) GROUP BY ALL ORDER BY live_viewers DESC, content_id LIMIT 20")
def live_top_content(m: Model) -> DataFrame:
    counts = live.live_counts(_live(m), "content_id").select("content_id", "live_viewers")
    named = counts.join(m.contents.select("content_id", "title", "video_type"), "content_id", "left").fillna({"title": "(unknown)", "video_type": "unknown"})
    return router.page(named, (F.col("live_viewers").desc(), "content_id"), 20)


@query(LIVE_STATE.replace("AS (SELECT * FROM ev QUALIFY", "AS (SELECT * FROM ev QUALIFY").replace("FROM dd", "FROM dc").replace(", lx AS", f", dc AS (SELECT * FROM dd WHERE event_ms <= (SELECT max(event_ms) - 86400000 * 10 FROM dd)), lx AS", 1).replace("FROM dc WHERE event_ms <= (SELECT max(event_ms) - 86400000 * 10 FROM dc)", "FROM dd WHERE event_ms <= (SELECT max(event_ms) - 86400000 * 10 FROM dd)").replace("max(event_ms) AS h FROM dc", "max(event_ms) - 86400000 * 10 AS h FROM dd") + f" SELECT {COUNTS} FROM lv")
def live_as_of(m: Model) -> DataFrame:
    at = m.horizon - 10 * DAY
    return live.live_counts(live.live_now(live.live_state(m.events.where(F.col("event_ms") <= at)), at, m.policy.timeout_ms))


@query(SESSIONS + " SELECT session_key, max(end_ms) AS lease_expiry_ms, max(end_ms) > (SELECT h FROM hz) AS is_active_now, session_key IN (SELECT session_key FROM dd WHERE signal = 'session_end') AS is_terminated, max(start_ms) AS open_start_ms FROM iv0 GROUP BY session_key")
def live_state(m: Model) -> DataFrame:
    return live.lease_state(m.bare, m.events, m.horizon)


# --- drops and baselines -------------------------------------------------------------------------

DROPS = _tier((1,)) + f""", w AS (SELECT {DAYS_BACK(20)} AS lo, {DAYS_BACK(17)} AS hi), ob AS (SELECT tier.* FROM tier, w WHERE bucket_ms >= lo - 15 * 3600000 AND bucket_ms < hi)
, gr AS (SELECT p.platform AS slice, unnest(generate_series(lo - 15 * 3600000, hi - 3600000, 3600000)) AS bucket_ms FROM (SELECT DISTINCT platform FROM ob) p, w)
, de AS (SELECT g.slice, g.bucket_ms, coalesce(o.active_ms, 0) / 3600000.0 AS observed, coalesce(o.peak, 0) AS peak FROM gr g LEFT JOIN ob o ON o.platform = g.slice AND o.bucket_ms = g.bucket_ms)
, sc AS (SELECT *, quantile_cont(observed, 0.5) OVER (PARTITION BY slice ORDER BY bucket_ms ROWS BETWEEN 15 PRECEDING AND 1 PRECEDING) AS raw FROM de)
, si AS (SELECT slice, bucket_ms, round(observed, 6) AS observed, peak, round(coalesce(raw, 0.0), 6) AS baseline, coalesce(raw >= 1.0, false) AS has_opinion, CASE WHEN raw >= 1.0 THEN least(1.0, round(observed / raw, 6)) ELSE 1.0 END AS retention FROM sc, w WHERE bucket_ms >= lo)
, ds AS (SELECT *, round(100.0 * (1.0 - retention), 3) AS drop_pct, max(retention) OVER (PARTITION BY slice ORDER BY bucket_ms ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS retention_sustained, bucket_ms < (SELECT h FROM hz) AS is_settled FROM si)"""


def _drops(m: Model) -> DataFrame:
    observed = m.tier((1,)).withColumn("slice", F.col("platform"))
    return live.drop_signal(observed, m.day(20), m.day(17), HOUR, 15, 1.0, 2, m.horizon)


@query(DROPS + " SELECT slice, bucket_ms, observed::DOUBLE AS observed, peak, baseline::DOUBLE AS baseline, has_opinion, retention::DOUBLE AS retention, drop_pct::DOUBLE AS drop_pct, retention_sustained::DOUBLE AS retention_sustained, is_settled FROM ds")
def drop_signal(m: Model) -> DataFrame:
    return _drops(m)


@query(DROPS + " SELECT slice, bucket_ms, retention_sustained::DOUBLE AS retention_sustained FROM ds WHERE has_opinion AND is_settled AND retention_sustained < 0.7")
def drop_breaches(m: Model) -> DataFrame:
    return live.breaches(_drops(m)).select("slice", "bucket_ms", "retention_sustained")


@query(DROPS + " SELECT slice, coalesce(min(retention_sustained) FILTER (has_opinion), 1.0)::DOUBLE AS worst, count(*) FILTER (has_opinion) AS opinions FROM ds GROUP BY slice")
def worst_retention(m: Model) -> DataFrame:
    return _drops(m).groupBy("slice").agg(F.coalesce(F.min(F.when(F.col("has_opinion"), F.col("retention_sustained"))), F.lit(1.0)).alias("worst"), F.count_if("has_opinion").alias("opinions"))


HEART = SESSIONS + CURVE0 + """, hb AS (SELECT DISTINCT session_key, unnest(generate_series(((event_ms + 3599999) // 3600000) * 3600000, ((event_ms + 43200000 - 1) // 3600000) * 3600000, 3600000)) AS bucket_ms FROM dd WHERE signal IN ('play', 'liveness', 'resume'))
, hc AS (SELECT bucket_ms, count(*) AS lease_sessions FROM hb GROUP BY 1)"""


@query(HEART + " SELECT bucket_ms, lease_sessions FROM hc")
def heartbeat_baseline(m: Model) -> DataFrame:
    return live.heartbeat_cover(m.events, m.policy.timeout_ms, HOUR).groupBy("bucket_ms").agg(F.count("*").alias("lease_sessions"))


@query(HEART + " SELECT bucket_ms, lease_sessions, coalesce(level, 0) AS exact_sessions, lease_sessions - coalesce(level, 0) AS overcount FROM hc ASOF LEFT JOIN c0 ON hc.bucket_ms >= c0.boundary_ms")
def overcount(m: Model) -> DataFrame:
    base = live.heartbeat_cover(m.events, m.policy.timeout_ms, HOUR).groupBy("bucket_ms").agg(F.count("*").alias("lease_sessions"))
    # the exact level at each bucket start: starts join the boundaries as points without change, and the running sum passes over both
    at = base.select(F.lit(0).alias("rollup_mask"), F.col("bucket_ms").alias("boundary_ms"), F.lit(0).cast("long").alias("opens"), F.lit(0).cast("long").alias("closes"))
    both = m.total().unionByName(at).groupBy("rollup_mask", "boundary_ms").agg(F.sum("opens").alias("opens"), F.sum("closes").alias("closes"))
    level = boundaries.curve(both, ("rollup_mask",)).select(F.col("boundary_ms").alias("bucket_ms"), F.col("level").alias("exact_sessions"))
    return base.join(level, "bucket_ms").select("bucket_ms", "lease_sessions", "exact_sessions", (F.col("lease_sessions") - F.col("exact_sessions")).alias("overcount"))


@query(SESSIONS + ", nv AS (SELECT min(event_ms) AS s, max(event_ms) AS e FROM dd GROUP BY session_key HAVING max(event_ms) > min(event_ms)), nc AS (SELECT t, sum(sum(d)) OVER (ORDER BY t ROWS UNBOUNDED PRECEDING) AS level FROM (SELECT s AS t, 1 AS d FROM nv UNION ALL SELECT e, -1 FROM nv) GROUP BY t) SELECT CAST(max(level) AS BIGINT) AS peak, arg_min(t, CAST(-level AS BIGINT) * 100000000000000 + t) AS peak_ms FROM nc")
def naive_span_concurrency(m: Model) -> DataFrame:
    spans = live.span_intervals(m.events).withColumn("rollup_mask", F.lit(0))
    return boundaries.peak(boundaries.curve(boundaries.deltas(spans, ("rollup_mask",)), ("rollup_mask",)))


TRUTH = EVENTS + """, e AS (SELECT *, event_ms - event_ms % 3600000 AS b FROM dd), o AS (SELECT session_key, min(b) AS b0, max(b) AS b1 FROM e GROUP BY 1)
, c AS (SELECT DISTINCT session_key, unnest([b, b + 3600000, b + 7200000]) AS bucket_ms FROM e WHERE event_type IN ('VideoSessionStart', 'VideoPlay', 'VideoHeartbeat', 'AppForegrounded'))
, w1 AS (SELECT session_key, event_ms, event_type = 'AppBackgrounded' AS opens, min(CASE WHEN event_type = 'AppForegrounded' THEN event_ms END) OVER (PARTITION BY session_key ORDER BY event_ms, row_version ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS until FROM e WHERE event_type IN ('AppBackgrounded', 'AppForegrounded'))
, w2 AS (SELECT session_key, event_ms, signal IN ('pause', 'error') AS opens, min(CASE WHEN signal IN ('play', 'resume') THEN event_ms END) OVER (PARTITION BY session_key ORDER BY event_ms, row_version ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS until FROM e WHERE signal IN ('pause', 'error', 'play', 'resume'))
, x AS (SELECT DISTINCT session_key, unnest(generate_series(greatest(((event_ms + 3599999) // 3600000) * 3600000, b0), coalesce(least(until - until % 3600000 - 3600000, b1), b1), 3600000)) AS bucket_ms FROM (SELECT * FROM w1 WHERE opens UNION ALL SELECT * FROM w2 WHERE opens) JOIN o USING (session_key))"""


@query(TRUTH + " SELECT bucket_ms, count(*) AS sessions FROM c JOIN o USING (session_key) WHERE bucket_ms BETWEEN b0 AND b1 AND NOT EXISTS (SELECT 1 FROM x WHERE x.session_key = c.session_key AND x.bucket_ms = c.bucket_ms) GROUP BY bucket_ms")
def ground_truth_minute(m: Model) -> DataFrame:
    return live.minute_ground_truth(m.events, HOUR)


@query(EVENTS + ", b AS (SELECT DISTINCT session_key, event_ms - event_ms % 3600000 AS x FROM dd), g AS (SELECT session_key, x, x - row_number() OVER (PARTITION BY session_key ORDER BY x) * 3600000 AS k FROM b) SELECT session_key, min(x) AS start_ms, max(x) + 3600000 AS end_ms FROM g GROUP BY session_key, k")
def array_runs(m: Model) -> DataFrame:
    return live.runs_of_buckets(m.events, HOUR).select("session_key", F.inline("runs"))


@query(EVENTS + ", g AS (SELECT session_key, event_ms, CASE WHEN event_ms - lag(event_ms) OVER (PARTITION BY session_key ORDER BY event_ms) <= 43200000 THEN 0 ELSE 1 END AS n FROM (SELECT DISTINCT session_key, event_ms FROM dd)), k AS (SELECT *, sum(n) OVER (PARTITION BY session_key ORDER BY event_ms ROWS UNBOUNDED PRECEDING) AS s FROM g) SELECT session_key, min(event_ms) AS start_ms, max(event_ms) + 43200000 AS end_ms, count(*) AS events FROM k GROUP BY session_key, s")
def session_gap_merge(m: Model) -> DataFrame:
    at = m.events.select("session_key", "event_ms").distinct().withColumn("at", F.timestamp_millis("event_ms"))
    out = at.groupBy("session_key", F.session_window("at", "12 hours").alias("w")).agg(F.count("*").alias("events"))
    return out.select("session_key", F.unix_millis("w.start").alias("start_ms"), F.unix_millis("w.end").alias("end_ms"), "events")


@query(SESSIONS + ", nm AS (SELECT d.session_key, d.event_ms, string_agg(DISTINCT signal, '+' ORDER BY signal) AS signals FROM dd d JOIN an a USING (session_key) WHERE d.event_ms >= coalesce(a.first_start, a.first_event) AND (a.terminal_end IS NULL OR d.event_ms <= a.terminal_end) AND (signal <> 'session_start' OR d.event_ms = coalesce(a.first_start, a.first_event)) GROUP BY ALL) SELECT session_key, event_ms, signals, CAST(fg_state AS INT) AS fg_state, CAST(play_state AS INT) AS play_state, started, ended, is_on AS \"on\", last_eligible, next_ms FROM ls JOIN nm USING (session_key, event_ms)")
def timeline(m: Model) -> DataFrame:
    return live.timeline(m.leased, m.clipped)


@query(EVENTS + " SELECT event_ms - event_ms % 3600000 AS bucket_ms, count(DISTINCT session_key) AS sessions, count(*) AS events FROM dd GROUP BY 1")
def liveness_curve(m: Model) -> DataFrame:
    return live.liveness_curve(m.events, HOUR)


@query(_tier((0,)) + f", w AS (SELECT {DAYS_BACK(31)} AS lo, {DAYS_BACK(-1)} AS hi), b AS (SELECT unnest(generate_series(lo, hi - 1, 3600000)) AS bucket_ms FROM w) SELECT b.bucket_ms, count(DISTINCT session_key) AS sessions FROM b LEFT JOIN sp USING (bucket_ms) GROUP BY 1")
def dense_curve(m: Model) -> DataFrame:
    return live.dense_curve(m.bare, m.day(31), m.day(-1), HOUR)


@query()
def hll_sessions(m: Model) -> DataFrame:
    cover = live.heartbeat_cover(m.events, m.policy.timeout_ms, HOUR)
    partial = cover.groupBy("bucket_ms", (F.col("session_key") % 4).alias("part")).agg(F.hll_sketch_agg("session_key").alias("state"))
    return partial.groupBy("bucket_ms").agg(F.hll_sketch_estimate(F.hll_union_agg("state")).alias("sessions"))


@query()
def fingerprint_hash(m: Model) -> DataFrame:
    return corrections.fingerprint(m.points((0,)), *KEYS, "boundary_ms", "opens", "closes")


@query(SESSIONS + " SELECT CAST(session_key % 4 AS VARCHAR) AS part, upper(sha256(string_agg(r, chr(10) ORDER BY r))) AS answer_hash, count(*) AS n FROM (SELECT session_key, length(CAST(session_key AS VARCHAR)) || ':' || session_key || '|' || length(CAST(start_ms AS VARCHAR)) || ':' || start_ms || '|' || length(CAST(end_ms AS VARCHAR)) || ':' || end_ms || '|' AS r FROM iv0) GROUP BY 1")
def answer_hash(m: Model) -> DataFrame:
    return corrections.answer_hash(m.bare, ("session_key", "start_ms", "end_ms"), (F.col("session_key") % 4).cast("string"))
