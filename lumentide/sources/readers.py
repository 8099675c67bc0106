"""Files in and out: validated CSV and JSON events, catalogue files, quarantine, batches, retention, day replacement."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumentide.functions import scalars as S

REQUIRED = ("video_session_id", "user_id", "content_id", "event_type", "event", "event_timestamp", "session_start_epoch", "platform", "app_version", "country", "audio_language", "subtitle_language", "player_version")
OPTIONAL = ("video_resolution",)
CONTENT_REQUIRED = ("content_id", "title", "video_type", "category")


class MissingColumns(ValueError):
    """A file lacks columns that it must have."""


def _by_header(rows: DataFrame, required: tuple[str, ...], optional: tuple[str, ...]) -> DataFrame:
    """Columns by their trimmed lower-case names, whatever their order; a byte order mark goes; optional ones default to ''."""
    there = {c.replace("﻿", "").strip().lower(): c for c in rows.columns}
    missing = [c for c in required if c not in there]
    if missing:
        raise MissingColumns(f"missing columns: {', '.join(missing)}")
    cols = [F.col(f"`{there[c]}`").alias(c) for c in required]
    return rows.select(*cols, *[F.coalesce(F.col(f"`{there[c]}`"), F.lit("")).alias(c) if c in there else F.lit("").alias(c) for c in optional])


def read_events_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text; a row with too few or too many values is kept and marked by bad_column_count."""
    rows = spark.read.option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", False).csv(path)
    named = _by_header(rows, REQUIRED, OPTIONAL)
    return named.withColumn("bad_column_count", F.col("player_version").isNull())


def read_events_json(spark: SparkSession, path: str, array: bool = False) -> DataFrame:
    """Newline-delimited objects, or one array of objects in each file."""
    return _by_header(spark.read.option("primitivesAsString", True).option("multiLine", array).json(path), REQUIRED, OPTIONAL)


def read_content_csv(spark: SparkSession, path: str) -> DataFrame:
    """content_id, title, video_type, category, show_name; empty kinds read ``unknown``; rows without a valid id go."""
    rows = _by_header(spark.read.option("header", True).csv(path), CONTENT_REQUIRED, ("show_name",))
    named = lambda c: F.coalesce(F.nullif(F.lower(F.trim(c)), F.lit("")), F.lit("unknown"))
    return rows.select(S.content_id(F.col("content_id")).alias("content_id"), F.coalesce(F.trim("title"), F.lit("")).alias("title"), named("video_type").alias("video_type"), named("category").alias("category"), "show_name").where("content_id is not null")


def latest_content(versions: DataFrame) -> DataFrame:
    """The newest source_version of each content."""
    rest = [c for c in versions.columns if c != "content_id"]
    return versions.groupBy("content_id").agg(F.max_by(F.struct(*rest), "source_version").alias("r")).select("content_id", "r.*")


def _reason() -> Column:
    reason = F.when(S.hex_id(F.col("video_session_id")).isNull(), "bad_session_id").when(S.hex_id(F.col("user_id")).isNull(), "bad_user_id")
    return reason.when(S.content_id(F.col("content_id")).isNull(), "bad_content_id").when(S.epoch_ms(F.col("event_timestamp")).isNull(), "bad_timestamp")


def validate(rows: DataFrame) -> DataFrame:
    """Adds reject_reason: the first that holds, null for a good row."""
    reason = _reason()
    if "bad_column_count" in rows.columns:
        reason = F.when(F.col("bad_column_count"), "bad_column_count").otherwise(reason)
    return rows.withColumn("reject_reason", reason)


def split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows with parsed columns, rejects with their reason and the row as JSON)."""
    checked = validate(rows)
    source = [c for c in rows.columns if c != "bad_column_count"]
    rejects = checked.where("reject_reason is not null").select("reject_reason", F.to_json(F.struct(*source)).alias("row"))
    good = checked.where("reject_reason is null").withColumns({
        "video_session_id": S.hex_id(F.col("video_session_id")),
        "user_id": S.hex_id(F.col("user_id")),
        "content_id": S.content_id(F.col("content_id")),
        "event_ms": S.epoch_ms(F.col("event_timestamp")),
        "session_key": F.xxhash64(S.hex_id(F.col("video_session_id"))),
        "user_key": F.xxhash64(S.hex_id(F.col("user_id"))),
    })
    return good.drop("reject_reason", "bad_column_count"), rejects


def clean(good: DataFrame, ingest_ms: int) -> DataFrame:
    """Normalised events with their signal, version and date.

    A row's version is the instant of ingestion and its place in the batch: rows before it in its partition, and in those before.
    """
    sizes = {r["part"]: r["n"] for r in good.groupBy(F.spark_partition_id().alias("part")).agg(F.count("*").alias("n")).collect()}
    before, starts = 0, []
    for part in range(max(sizes, default=-1) + 1):
        starts.append(before)
        before += sizes.get(part, 0)
    place = F.element_at(F.array(*map(F.lit, starts or [0])).cast("array<long>"), F.spark_partition_id() + 1) + F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    return good.withColumns({
        "audio_language": S.language(F.col("audio_language")),
        "subtitle_language": S.language(F.col("subtitle_language")),
        "player_version": S.player_version(F.col("player_version")),
        "video_resolution": S.resolution(F.col("video_resolution")),
        "signal": S.signal(F.col("event_type"), F.col("event")),
        "is_periodic_ping": S.is_ping(F.col("event")),
        "row_version": S.row_version(F.lit(ingest_ms), place),
        "event_date": F.to_date(F.timestamp_millis("event_ms")),
    })


def file_fingerprints(spark: SparkSession, path: str) -> DataFrame:
    """path, size, sha256 of each file."""
    return spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"))


def batch_id(fingerprint: str, ordinal: int, rows: int) -> str:
    """The same chunk of the same file always has the same id."""
    import hashlib

    return hashlib.sha256(f"{fingerprint}|{ordinal}|{rows}".encode()).hexdigest()


def append_once(rows: DataFrame, folder: str, token: str, *by: str) -> bool:
    """Appends rows as one batch, in folders by the columns ``by``; a batch whose token is there already is not written again.

    The batch is made in a folder that readers pass over and appears whole by its renaming; of two writers of one
    token one finds the other's batch and takes its own away.
    """
    spark = rows.sparkSession
    path = lambda name: spark._jvm.org.apache.hadoop.fs.Path(name)
    done, making = f"{folder}/batch={token}", f"_making-{uuid.uuid4().hex}"
    files = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(path(done)):
        return False
    rows.write.partitionBy(*by).parquet(f"{folder}/{making}")
    files.rename(path(f"{folder}/{making}"), path(done))
    # a rename to a folder that is there by now either fails or moves into it
    late = [x for x in (f"{folder}/{making}", f"{done}/{making}") if files.exists(path(x))]
    for x in late:
        files.delete(path(x), True)
    return not late


def replace_days(rows: DataFrame, folder: str, day: str = "service_date") -> None:
    """Replaces the days that rows have, and no other."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(folder)


def write_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).csv(path)


def audit(batch: str, good: DataFrame, rejects: DataFrame, folder: str) -> None:
    """Control rows of a batch: counts by outcome, and the rejects themselves."""
    counts = rejects.groupBy("reject_reason").agg(F.count("*").alias("n"))
    counts = counts.unionByName(good.agg(F.count("*").alias("n")).withColumn("reject_reason", F.lit("")))
    append_once(counts.withColumn("batch_id", F.lit(batch)), f"{folder}/batches", batch)
    append_once(rejects.withColumn("batch_id", F.lit(batch)), f"{folder}/rejects", batch)
