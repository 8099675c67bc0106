"""The parameters of the activity predicate and of what is published from it."""

from __future__ import annotations

from dataclasses import dataclass

#: Bits of a rollup mask, by dimension.
BITS = {"platform": 1, "country": 2, "content_id": 4, "video_type": 8, "app_version": 16, "category": 32}
#: Masks of the dense tier, of the boundary deltas, and of the minute rollup.
TIER_MASKS = (0, 1, 2, 3, 4, 5, 8, 9, 15)
DELTA_MASKS = (0, 1, 2, 3, 4, 5, 8, 9, 12, 15)
ROLLUP_MASKS = (0, 1, 2, 3, 4, 5, 8, 9, 16, 32, 63)
#: What each mask is called.
GROUPINGS = {
    0: "total", 1: "platform", 2: "country", 3: "platform + country", 4: "content", 5: "platform + content", 8: "video type", 9: "platform + video type",
    12: "content + video type", 15: "platform + country + content + video type", 16: "app version", 32: "category", 63: "all dimensions",
}
MINUTE, HOUR, DAY = 60_000, 3_600_000, 86_400_000


@dataclass(frozen=True)
class Policy:
    """timeout_ms: a session is active until so long after its last eligible signal; times are epoch milliseconds.

    include_boundary_sessions: sessions without a start count from their first event;
    drop_later_starts: start signals after the first are ignored.
    """

    timeout_ms: int = 120_000
    bucket_ms: int = MINUTE
    include_boundary_sessions: bool = True
    drop_later_starts: bool = True


#: The policy over the driver's tables, whose events are hours apart.
WIDE = Policy(timeout_ms=12 * HOUR, bucket_ms=HOUR)
