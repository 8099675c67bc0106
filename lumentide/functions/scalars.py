"""Column functions: classification, normalisation, parsing of dirty input, masks and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lumentide.policy import BITS, GROUPINGS

#: Player event types with the signal each one is.
SIGNAL_OF_TYPE = {
    "VideoSessionStart": "session_start",
    "VideoSessionEnd": "session_end",
    "VideoPlay": "play",
    "AppBackgrounded": "background",
    "AppForegrounded": "foreground",
    "VideoError": "error",
}
#: Events that players send periodically.
PINGS = ("network-activity", "buffer-health", "video-resize")
UNKNOWN_LANGUAGES = ("", "unk", "und", "null", "unknown")
UNKNOWN_RESOLUTIONS = ("", "na", "auto", "auto-auto", "null", "unknown")
LIVENESS = ("play", "resume", "liveness")


def signal(event_type: Column, event: Column) -> Column:
    """The signal of an event: by its type, else pause or resume by its exact name, else liveness."""
    out = F.when(F.lower(event) == "pause", "pause").when(F.lower(event) == "resume", "resume").otherwise("liveness")
    by_type = F.create_map(*[F.lit(x) for pair in SIGNAL_OF_TYPE.items() for x in pair])
    return F.coalesce(F.try_element_at(by_type, event_type), out)


def is_ping(event: Column) -> Column:
    return F.coalesce(event.isin(*PINGS), F.lit(False))


def language(c: Column) -> Column:
    """First subtag, in small letters."""
    tag = F.lower(F.get(F.split(F.trim(c), "-"), F.lit(0)))
    return F.when(tag.isNull() | tag.isin(*UNKNOWN_LANGUAGES), "unknown").otherwise(tag)


def player_version(c: Column) -> Column:
    return F.coalesce(F.nullif(F.trim(c), F.lit("")), F.lit("unknown"))


def resolution(c: Column) -> Column:
    flat = F.lower(F.replace(F.trim(c), F.lit(" "), F.lit("")))
    return F.when(flat.isNull() | flat.isin(*UNKNOWN_RESOLUTIONS), "unknown").otherwise(flat)


def row_version(ingest_ms: Column, place: Column) -> Column:
    """Later batches, then later rows of a batch, are newer."""
    return F.shiftleft(ingest_ms.cast("long"), 20) + place.cast("long")


def hex_id(c: Column) -> Column:
    """64 hexadecimal digits in capitals, else null."""
    return F.when(F.trim(c).rlike("^[0-9A-Fa-f]{64}$"), F.upper(F.trim(c)))


def content_id(c: Column) -> Column:
    """A signed 64-bit id; text of an unsigned one wraps to its negative; else null."""
    wide = F.when(F.trim(c).rlike("^-?[0-9]{1,20}$"), F.trim(c).try_cast("decimal(20,0)"))
    wrapped = F.when(wide >= F.lit("9223372036854775808").cast("decimal(20,0)"), wide - F.lit("18446744073709551616").cast("decimal(20,0)")).otherwise(wide)
    return wrapped.try_cast("long")


def epoch_ms(c: Column) -> Column:
    """Epoch milliseconds between 2000 and 2100 without a fraction, else null (another unit, or no number)."""
    text = F.trim(c)
    whole = F.when(text.rlike("^-?[0-9]{1,18}(\\.0*)?$"), F.split(text, "\\.")[0].try_cast("long"))
    return F.when((whole >= 946_684_800_000) & (whole < 4_102_444_800_000), whole)


def masked(mask: Column, name: str, cleared: str | int = "") -> Column:
    """The dimension where the mask has its bit, else the sentinel for "all"."""
    bit = BITS[name]
    return F.when(mask.bitwiseAND(bit) == bit, F.col(name)).otherwise(F.lit(cleared))


def grouping(mask: Column) -> Column:
    names = F.create_map(*[F.lit(x) for pair in GROUPINGS.items() for x in pair])
    return F.coalesce(F.try_element_at(names, mask.cast("int")), F.concat(F.lit("mask "), mask.cast("string")))


def label(*dims: Column) -> Column:
    """The dimensions that are set, joined; "all" if none is."""
    return F.coalesce(F.nullif(F.concat_ws(" · ", *[F.nullif(d.cast("string"), F.lit("")) for d in dims]), F.lit("")), F.lit("all"))


def bucket(ms: Column, size: int) -> Column:
    return ms - F.pmod(ms, F.lit(size))


def canonical(*cols: Column) -> Column:
    """Each value with its length before it, so that no two rows read alike."""
    texts = [F.coalesce(c.cast("string"), F.lit("")) for c in cols]
    return F.concat(*[x for t in texts for x in (F.length(t).cast("string"), F.lit(":"), t, F.lit("|"))])


def share(part: Column, whole: Column) -> Column:
    """Percent, null for an empty whole."""
    return F.round(100.0 * part / F.nullif(whole, F.lit(0)), 6)


def yyyymmdd(t: Column) -> Column:
    return F.date_format(t, "yyyyMMdd").cast("int")


def yyyymm(t: Column) -> Column:
    return F.date_format(t, "yyyyMM").cast("int")


def instant_ms(text: Column) -> Column:
    """Epoch milliseconds of a date or an instant, with or without a zone, null for other text."""
    return F.unix_millis(F.try_to_timestamp(F.trim(text)))


def fingerprint(*cols: Column) -> Column:
    """128 bits of the values, as hex; nulls are left out."""
    return F.md5(F.concat_ws("|", *[c.cast("string") for c in cols]))


def readable_size(size: Column) -> Column:
    """Bytes as text in the largest binary unit that they reach."""
    units = ("B", "KiB", "MiB", "GiB", "TiB", "PiB")
    out = F.format_string("%.2f PiB", size / 1024.0**5)
    for i, unit in reversed(list(enumerate(units[:-1]))):
        out = F.when(size < 1024.0 ** (i + 1), F.format_string(f"%.2f {unit}", size / 1024.0**i)).otherwise(out)
    return out
