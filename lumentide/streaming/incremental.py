"""Arriving events: idempotent landing, touched sessions recomputed in full, live state, sealing.

State that does not commute is never updated in place: a batch marks the sessions that it
touches, and those are computed again from their whole history with the same functions as in a
full build, so late, repeated and shuffled events converge to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType

from lumentide.operators import sessions
from lumentide.policy import Policy
from lumentide.sources.readers import append_once


#: Folders by session that a batch's events are dealt into.
PARTS = 64


def recompute_touched(history: DataFrame, touched: DataFrame, policy: Policy, as_of: int) -> DataFrame:
    """Intervals of the touched sessions, from all their events."""
    own = history.join(touched, "session_key", "left_semi")
    return sessions.active_intervals(sessions.dedup_latest(own), policy, as_of)


class IntervalStream:
    """Lands micro-batches of clean events and keeps revisions of the intervals of touched sessions.

    A batch that is delivered again writes nothing: both tables are keyed by the batch id.
    A session that has no interval any more leaves a tombstone, so its old revision ends.
    Events lie in folders by session, so a batch reads the history of the folders of its own sessions only; the
    horizon is kept as a row of each batch.
    """

    def __init__(self, folder: str, policy: Policy):
        self.folder, self.policy = folder, policy

    def batch(self, rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        dealt = rows.withColumn("part", F.pmod(F.xxhash64("session_key"), F.lit(PARTS)).cast("int"))
        append_once(dealt, f"{self.folder}/events", f"{batch_id:08d}", "part")
        landed = self.read(spark, "events", dealt.schema).where(F.col("batch") <= batch_id)
        own = landed.where(F.col("batch") == batch_id)
        append_once(own.agg(F.max("event_ms").alias("event_ms")), f"{self.folder}/horizons", f"{batch_id:08d}")
        horizons = spark.read.parquet(f"{self.folder}/horizons").where(F.col("batch") <= batch_id)
        parts = [r["part"] for r in own.select("part").distinct().collect()]  # PARTS rows at most
        history = landed.where(F.col("part").isin(parts)).drop("batch", "part")
        touched = own.select("session_key").distinct()
        as_of = sessions.horizon(horizons) + self.policy.timeout_ms
        made = recompute_touched(history, touched, self.policy, as_of)
        out = touched.join(made, "session_key", "left").withColumn("state_revision", F.lit(batch_id).cast("long"))
        append_once(out, f"{self.folder}/intervals", f"{batch_id:08d}")

    def read(self, spark: SparkSession, name: str, schema: StructType) -> DataFrame:
        return spark.read.schema(StructType([*schema.fields, StructField("batch", IntegerType())])).parquet(f"{self.folder}/{name}")

    def start(self, stream: DataFrame, checkpoint: str) -> StreamingQuery:
        return stream.writeStream.foreachBatch(self.batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    def current(self, spark: SparkSession) -> DataFrame:
        """Intervals as of the batches so far."""
        return sessions.current_revision(spark.read.parquet(f"{self.folder}/intervals").drop("batch"))


_FG = {"session_start": 1, "foreground": 1, "play": 1, "resume": 1, "liveness": 1, "background": 0, "session_end": 0}
_PLAY = {"play": 1, "resume": 1, "pause": 0, "error": 0, "session_end": 0}


def _last_set(values: dict[str, int]) -> Column:
    """What the signals of the last instant that has any of these set; of signals of one instant the one that stops holds."""
    stops = F.when(F.col("signal").isin(*[k for k, v in values.items() if v]), 0).when(F.col("signal").isin(*[k for k, v in values.items() if not v]), 1)
    mark = F.max(F.col("event_ms") * 2 + stops)  # the instant, and its last bit whether it stops
    return F.coalesce(1 - F.pmod(mark, F.lit(2)), F.lit(0)).cast("int")


def live_state_stream(events: DataFrame) -> DataFrame:
    """Latest state of each session that a micro-batch has events of: sums of maxima, so order does not matter."""
    last, ended = F.max("event_ms").alias("last_event_ms"), F.max(F.col("signal") == "session_end").alias("terminated")
    return events.groupBy("session_key").agg(last, ended, _last_set(_FG).alias("fg"), _last_set(_PLAY).alias("play"))


def net_stream(points: DataFrame, size: int) -> DataFrame:
    """Net change of each bucket, summed over all arrivals: the additive view of boundary rows."""
    at = F.col("boundary_ms") - F.pmod("boundary_ms", F.lit(size))
    return points.groupBy(at.alias("bucket_ms")).agg(F.sum("opens").alias("opens"), F.sum("closes").alias("closes"), F.count("*").alias("n_deltas"))


def seal(watermark: int, horizon: int, grace: int = 120_000, most: int = 1_800_000, size: int = 60_000) -> int:
    """The next seal watermark: whole buckets, never back, behind the horizon by the grace, at most ``most`` at once."""
    return max(watermark, min((horizon - grace) // size * size, watermark + most))


def cut_over(sealed: DataFrame, exact: DataFrame, watermark: int) -> DataFrame:
    """Sealed buckets before the watermark, exact ones from it on."""
    return sealed.where(F.col("bucket_ms") < watermark).unionByName(exact.where(F.col("bucket_ms") >= watermark))
