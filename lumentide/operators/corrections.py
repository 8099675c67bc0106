"""Distinct users, signed corrections, and the bookkeeping of incremental batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumentide.functions.scalars import bucket, canonical
from lumentide.operators.boundaries import KEYS
from lumentide.operators.sessions import islands
from lumentide.policy import DAY


def user_intervals(fanned: DataFrame) -> DataFrame:
    """A user's intervals united per mask and dimensions, so that a user counts once however many sessions are active."""
    keys = ("user_key", *KEYS)
    merged = islands(fanned.select(*keys, "start_ms", "end_ms"), keys)
    return merged.groupBy(*keys, "interval_index").agg(F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms"))


def signed_boundaries(parts: DataFrame, sign: int, entity: str = "session_key") -> DataFrame:
    """entity, KEYS, boundary_ms, delta of intervals: a start counts sign, an end -sign."""
    ends = F.explode(F.array(F.struct(F.col("start_ms").alias("at"), F.lit(sign).alias("d")), F.struct(F.col("end_ms").alias("at"), F.lit(-sign).alias("d")))).alias("b")
    return parts.select(entity, *KEYS, ends).select(entity, *KEYS, F.col("b.at").alias("boundary_ms"), F.col("b.d").alias("delta"))


def correction(new: DataFrame, old: DataFrame) -> DataFrame:
    """What to add to the published boundaries to get from the old intervals to the new; changes that cancel are left out."""
    both = signed_boundaries(new, 1).unionByName(signed_boundaries(old, -1))
    return both.groupBy("session_key", *KEYS, "boundary_ms").agg(F.sum("delta").alias("delta")).where("delta <> 0")


def net_points(rows: DataFrame, *more: str) -> DataFrame:
    """KEYS, boundary_ms, delta summed over a ledger; zero sums go."""
    return rows.groupBy(*KEYS, *more, "boundary_ms").agg(F.sum("delta").alias("delta")).where("delta <> 0")


def day_split(parts: DataFrame) -> DataFrame:
    """One row of each part for each UTC day that it is in, cut to the day, with service_day_ms."""
    days = F.sequence(bucket(F.col("start_ms"), DAY), bucket(F.col("end_ms") - 1, DAY), F.lit(DAY).cast("long"))
    out = parts.withColumn("service_day_ms", F.explode(days))
    return out.withColumns({"start_ms": F.greatest("start_ms", "service_day_ms"), "end_ms": F.least("end_ms", F.col("service_day_ms") + DAY)})


def overlay(committed: DataFrame, candidates: DataFrame, touched: DataFrame) -> DataFrame:
    """Committed rows less those of touched sessions, and the candidates in their place."""
    return committed.join(touched, "session_key", "left_anti").unionByName(candidates)


def tombstones(committed: DataFrame, candidates: DataFrame, touched: DataFrame) -> DataFrame:
    """Touched sessions that had intervals and have none any more."""
    had = committed.select("session_key").distinct().join(touched, "session_key", "left_semi")
    return had.join(candidates, "session_key", "left_anti")


def workset(dirty: DataFrame, applied: DataFrame, leased: DataFrame, size: int) -> DataFrame:
    """Up to ``size`` dirty sessions, longest dirty first, that are neither applied since nor leased."""
    queue = dirty.groupBy("session_key").agg(F.min("dirty_ms").alias("since_ms"), F.max("dirty_ms").alias("until_ms"))
    done = applied.select("session_key", "applied_ms")
    queue = queue.join(done, (queue.session_key == done.session_key) & (done.applied_ms >= queue.until_ms), "left_anti")
    return queue.join(leased.select("session_key").distinct(), "session_key", "left_anti").orderBy("since_ms", "session_key").limit(size)


def next_version(changes: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The newest state of each key, by version and then by change number."""
    rest = [c for c in changes.columns if c not in keys]
    return changes.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct("version", "change")).alias("s")).select(*keys, "s.*")


def fingerprint(rows: DataFrame, *cols: str) -> DataFrame:
    """n, total and exclusive-or of row hashes: alike for the same rows in any order."""
    h = F.xxhash64(*cols)
    return rows.agg(F.count("*").alias("n"), F.sum(h.cast("decimal(38,0)")).cast("string").alias("sum_hash"), F.coalesce(F.bit_xor(h), F.lit(0)).alias("xor_hash"))


def answer_hash(rows: DataFrame, cols: tuple[str, ...], group: Column) -> DataFrame:
    """SHA-256 of the sorted canonical rows of each group: exact, for results of bounded size."""
    return rows.select(group.alias("part"), canonical(*map(F.col, cols)).alias("row")).groupBy("part").agg(F.upper(F.sha2(F.array_join(F.sort_array(F.collect_list("row")), "\n"), 256)).alias("answer_hash"), F.count("*").alias("n"))


def difference(left: DataFrame, right: DataFrame, keys: tuple[str, ...], value: str) -> DataFrame:
    """Rows of a full outer join whose values differ, absent ones counting as 0."""
    a, b = left.select(*keys, F.col(value).alias("left_value")), right.select(*keys, F.col(value).alias("right_value"))
    out = a.join(b, list(keys), "full_outer").fillna(0, ["left_value", "right_value"])
    return out.where(~F.col("left_value").eqNullSafe(F.col("right_value")))


def retained(rows: DataFrame, at: str, as_of: int, keep_ms: int) -> DataFrame:
    """Rows that a time to live has not expired."""
    return rows.where(F.col(at) > as_of - keep_ms)


def numbered(rows: DataFrame, order: str) -> DataFrame:
    return rows.withColumn("change", F.row_number().over(Window.partitionBy("session_key").orderBy(order)))
