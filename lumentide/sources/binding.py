"""The session model over the driver's tables.

The generic event stream stands in for player events: the kind of event and the number in its
properties give a player event type and name, from which the signal is classified as for real
input.  A tenth of the events come a second time with a newer version and another content.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumentide.functions.scalars import is_ping, signal

VIEWERS_A_USER = 50


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Player events without the copies."""
    e = read(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", F.unix_millis(F.col("ts").cast("timestamp")).alias("event_ms"), F.get_json_object("props", "$.k").cast("int").alias("k")
    )
    kind, k = F.col("event_type"), F.col("k")
    player = (
        F.when(kind == "view", "VideoPlay")
        .when((kind == "error") & (k % 2 != 0), "VideoError")
        .when((kind == "signup") & (k % 20 == 0), "VideoSessionEnd")
        .when((kind == "signup") & (k % 4 == 1), "VideoSessionStart")
        .when((kind == "signup") & (k % 4 == 3), "AppBackgrounded")
        .when(kind == "signup", "AppForegrounded")
        .otherwise("VideoHeartbeat")
    )
    name = F.when(kind == "purchase", "resume").when((kind == "error") & (k % 2 == 0), "pause").when(k % 3 == 0, "buffer-health").otherwise("network-activity")
    customer = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("platform"), F.col("c_nationkey").alias("n_nationkey"))
    nation = read(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("country"))
    viewer = customer.join(nation, "n_nationkey", "left").drop("n_nationkey")
    return e.join(viewer, "user_id", "left").select(
        F.col("user_id").alias("session_key"),
        (F.col("user_id") % VIEWERS_A_USER).alias("user_key"),
        "event_ms",
        player.alias("event_type"),
        name.alias("event"),
        F.col("event_id").alias("row_version"),
        k.cast("long").alias("content_id"),
        F.coalesce("platform", F.lit("unknown")).alias("platform"),
        F.coalesce("country", F.lit("unknown")).alias("country"),
        F.concat(F.lit("v"), (k % 7).cast("string")).alias("app_version"),
    )


def clean_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All player events, copies among them, with their signals."""
    raw = raw_events(spark, sf_dir)
    again = raw.where("row_version % 10 = 0").withColumn("row_version", F.col("row_version") + 1_000_000_000).withColumn("content_id", F.col("content_id") + 1)
    both = raw.unionByName(again)
    return both.withColumn("signal", signal(F.col("event_type"), F.col("event"))).withColumn("is_periodic_ping", is_ping(F.col("event")))


def contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue: content_id, title, video_type, category."""
    return read(spark, sf_dir, "part").select(F.col("p_partkey").alias("content_id"), F.col("p_name").alias("title"), F.col("p_type").alias("video_type"), F.col("p_brand").alias("category"))


#: The same model for the oracle: DuckDB views of one chain; each query takes what it needs.
SQL = """
raw0 AS (
  SELECT event_id, user_id, event_type AS kind, epoch_us(ts) // 1000 AS event_ms, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events
), raw AS (
  SELECT e.user_id AS session_key, e.user_id % 50 AS user_key, e.event_ms,
    CASE WHEN kind = 'view' THEN 'VideoPlay' WHEN kind = 'error' AND k % 2 <> 0 THEN 'VideoError'
      WHEN kind = 'signup' AND k % 20 = 0 THEN 'VideoSessionEnd' WHEN kind = 'signup' AND k % 4 = 1 THEN 'VideoSessionStart'
      WHEN kind = 'signup' AND k % 4 = 3 THEN 'AppBackgrounded' WHEN kind = 'signup' THEN 'AppForegrounded' ELSE 'VideoHeartbeat' END AS event_type,
    CASE WHEN kind = 'purchase' THEN 'resume' WHEN kind = 'error' AND k % 2 = 0 THEN 'pause' WHEN k % 3 = 0 THEN 'buffer-health' ELSE 'network-activity' END AS event,
    CASE WHEN kind = 'view' THEN 'play' WHEN kind = 'purchase' THEN 'resume' WHEN kind = 'error' AND k % 2 = 0 THEN 'pause' WHEN kind = 'error' THEN 'error'
      WHEN kind = 'signup' AND k % 20 = 0 THEN 'session_end' WHEN kind = 'signup' AND k % 4 = 1 THEN 'session_start'
      WHEN kind = 'signup' AND k % 4 = 3 THEN 'background' WHEN kind = 'signup' THEN 'foreground' ELSE 'liveness' END AS signal,
    e.event_id AS row_version, CAST(k AS BIGINT) AS content_id, coalesce(c.c_mktsegment, 'unknown') AS platform, coalesce(n.n_name, 'unknown') AS country,
    'v' || CAST(k % 7 AS VARCHAR) AS app_version
  FROM raw0 e LEFT JOIN customer c ON c.c_custkey = e.user_id LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
), ev AS (
  SELECT * FROM raw UNION ALL SELECT * REPLACE (row_version + 1000000000 AS row_version, content_id + 1 AS content_id) FROM raw WHERE row_version % 10 = 0
), dd AS (
  SELECT * FROM ev QUALIFY row_number() OVER (PARTITION BY session_key, event_ms, event_type, event ORDER BY row_version DESC) = 1
), content AS (
  SELECT p_partkey AS content_id, p_name AS title, p_type AS video_type, p_brand AS category FROM part
)"""
