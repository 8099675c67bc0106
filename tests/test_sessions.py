"""The activity predicate on small scenarios, and the properties that hold on any order of arrival."""

import random

import pytest

from lumentide.operators import boundaries, corrections, sessions, tiers
from lumentide.operators.boundaries import KEYS
from lumentide.plans.registry import Model
from lumentide.policy import WIDE, Policy

T0 = 1_785_000_000_000
POLICY = Policy()

SCENARIOS = {
    "normal": ([(0, "session_start"), (1, "play"), *[(t, "liveness") for t in range(60, 300, 60)], (300, "session_end")], [(1, 300)]),
    "no start, with play": ([(0, "play"), *[(t, "liveness") for t in range(60, 301, 60)]], [(0, 420)]),
    "heartbeats only": ([(t, "liveness") for t in range(0, 301, 60)], [(0, 420)]),
    "pause closes at its time": ([(0, "session_start"), (0, "play"), (60, "liveness"), (120, "pause"), (180, "liveness"), (240, "liveness")], [(0, 120)]),
    "background": ([(0, "session_start"), (0, "play"), (60, "liveness"), (120, "background"), (180, "liveness")], [(0, 120)]),
    "end locks": ([(0, "session_start"), (0, "play"), (60, "liveness"), (120, "session_end"), (180, "liveness"), (190, "play")], [(0, 120)]),
    "silence ends at the lease": ([(0, "session_start"), (0, "play"), (1000, "liveness")], [(0, 120), (1000, 1120)]),
    "foreground does not revive": ([(0, "session_start"), (0, "play"), (200, "foreground"), (260, "liveness")], [(0, 120), (260, 380)]),
    "resume revives": ([(0, "session_start"), (0, "play"), (200, "resume")], [(0, 120), (200, 320)]),
    "stop wins in one instant": ([(0, "session_start"), (0, "play"), (60, "pause"), (60, "resume")], [(0, 60)]),
    "resume after pause": ([(0, "session_start"), (0, "play"), (30, "pause"), (50, "resume")], [(0, 30), (50, 170)]),
    "background and back": ([(0, "session_start"), (0, "play"), (30, "background"), (40, "foreground")], [(0, 30), (40, 120)]),
    "later starts are ignored": ([(0, "session_start"), (0, "play"), (30, "background"), (40, "session_start")], [(0, 30)]),
    "error stops": ([(0, "session_start"), (0, "play"), (30, "error")], [(0, 30)]),
    "only a start": ([(0, "session_start")], []),
}


def frame(spark, rows):
    """(session, second, signal) as clean events."""
    full = [(s, s % 3, T0 + t * 1000, signal, signal, signal, i, 7, "ios", "DE", "v1") for i, (s, t, signal) in enumerate(rows)]
    return spark.createDataFrame(full, "session_key long, user_key long, event_ms long, event_type string, event string, signal string, row_version long, content_id long, platform string, country string, app_version string")


def found(intervals):
    out = {}
    for r in intervals.collect():
        out.setdefault(r.session_key, []).append(((r.start_ms - T0) / 1000, (r.end_ms - T0) / 1000))
    return {k: sorted(v) for k, v in out.items()}


def test_scenarios(spark):
    names = list(SCENARIOS)
    rows = [(i, t, s) for i, n in enumerate(names) for t, s in SCENARIOS[n][0]]
    got = found(sessions.active_intervals(frame(spark, rows), POLICY))
    for i, n in enumerate(names):
        assert got.get(i, []) == SCENARIOS[n][1], n


def test_boundary_sessions_can_be_left_out(spark):
    rows = [(1, t, s) for t, s in SCENARIOS["normal"][0]] + [(2, t, s) for t, s in SCENARIOS["heartbeats only"][0]]
    got = found(sessions.active_intervals(frame(spark, rows), Policy(include_boundary_sessions=False)))
    assert set(got) == {1}


def random_rows(seed, sessions_=12, events=30):
    r = random.Random(seed)
    kinds = ["session_start", "play", "resume", "pause", "background", "foreground", "error", "liveness", "liveness", "liveness", "session_end"]
    return [(s, r.randrange(0, 3000, 10), r.choice(kinds[: 11 if r.random() < 0.1 else 10])) for s in range(sessions_) for _ in range(r.randint(1, events))]


@pytest.mark.parametrize("seed", [1, 2])
def test_order_and_copies_do_not_matter(spark, seed):
    rows = random_rows(seed)
    events = frame(spark, rows)
    plain = found(sessions.active_intervals(sessions.dedup_latest(events), POLICY))
    mixed = events.unionByName(events.where("row_version % 3 = 0")).orderBy("row_version", ascending=False).repartition(7)
    assert found(sessions.active_intervals(sessions.dedup_latest(mixed), POLICY)) == plain


def test_curve_tier_and_intervals_agree(spark):
    events = sessions.dedup_latest(frame(spark, random_rows(3)))
    intervals = sessions.active_intervals(events, POLICY).withColumn("video_type", sessions.F.lit("movie"))
    fanned = boundaries.fan_out(intervals, (0, 1))
    points = boundaries.deltas(fanned)
    rows = [r.asDict() for r in intervals.collect()]
    level = {r.boundary_ms: r.level for r in boundaries.curve(points).where("rollup_mask = 0").collect()}
    assert all(n == sum(i["start_ms"] <= t < i["end_ms"] for i in rows) for t, n in level.items())
    for r in tiers.dense_tier(fanned, points, 60_000).where("rollup_mask = 0").collect():
        inside = [i for i in rows if i["start_ms"] < r.bucket_ms + 60_000 and i["end_ms"] > r.bucket_ms]
        assert r.active_ms == sum(min(i["end_ms"], r.bucket_ms + 60_000) - max(i["start_ms"], r.bucket_ms) for i in inside)
        at = [r.bucket_ms, *[i["start_ms"] for i in inside if i["start_ms"] >= r.bucket_ms]]
        assert r.peak == max(sum(i["start_ms"] <= t < i["end_ms"] for i in rows) for t in at)


def test_a_late_pause_is_corrected(spark):
    base = [(s, t, k) for s in range(4) for t, k in SCENARIOS["normal"][0]]
    late = [*base, (2, 100, "pause")]
    build = lambda rows: boundaries.fan_out(sessions.active_intervals(frame(spark, rows), POLICY, T0 + 10**6).withColumn("video_type", sessions.F.lit("")), (0, 1))
    old, new = build(base), build(late)
    fix = corrections.correction(new, old).collect()
    assert {r.session_key for r in fix} == {2} and sum(r.delta for r in fix) == 0
    fixed = corrections.net_points(corrections.signed_boundaries(old, 1).unionByName(corrections.correction(new, old)))
    assert corrections.difference(fixed, corrections.net_points(corrections.signed_boundaries(new, 1)), (*KEYS, "boundary_ms"), "delta").count() == 0


def test_empty_input(spark):
    none = frame(spark, [(1, 0, "play")]).limit(0)
    assert sessions.active_intervals(none, POLICY).count() == 0


def test_known_figures(spark):
    """Counts that an independent draft in another engine had given for these tables."""
    for sf, n, active, total, peak in (("0.001", 108, 13, 4_999_814_394, 5), ("0.01", 970, 119, 46_783_792_798, 33)):
        m = Model(spark, f"/root/testdata/sf{sf}", WIDE)
        rows = m.bare.collect()
        assert (len(rows), len({r.session_key for r in rows}), sum(r.end_ms - r.start_ms for r in rows)) == (n, active, total)
        assert boundaries.peak(m.levels()).first().peak == peak


def test_one_shuffle_of_events_builds_intervals(spark, sf):
    m = Model(spark, sf)
    plan = sessions.active_intervals(frame(spark, random_rows(1)), WIDE, T0 + 10**9)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1, plan
    assert m.horizon > 0
