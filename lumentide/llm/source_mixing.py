"""Mixing sources to target weights by a time-varying curriculum.

Each source has a target number of words and a weight schedule over training time
t in [0, 1].  The schedule's integral, scaled to the target, is the source's cumulative
demand; a document that begins at word c of the source's stream is due where that
demand reaches c, so its training position is the inverse of the demand at c.  The
documents, range-sorted by position, are the mix.

A source's stream is its documents in the order of md5(doc_id), repeated: up to
``most_passes`` passes.  The last pass ends within a document where the target is met.

Only DataFrame functions run on the executors.  The running word count of a source is
taken in two levels, over hash ranges of the stream and inside each, so a source that
holds a third of all rows is spread over many tasks.

Semantics: a null text has size 0; a null source is a source of its own, last in order;
rows that repeat are documents of their own; no rows give no rows.  A document of which
nothing is taken has no position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumentide.llm.common import Scratch

WORDS = r"[^\x20\x09-\x0D]+"
#: Source weights, repeating over the sources in order.
WEIGHTS = (5, 2, 1)
#: (start, end) of the linear schedules that go with those weights; the mean of each is 1:
#: heavy sources lead, light ones come late.
SCHEDULES = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))
MOST_PASSES = 3
#: Rows of one source that a window task sorts.
ROWS_A_RANGE = 20_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_passes: int = MOST_PASSES) -> DataFrame:
    """source, n_docs, source_size, kind (place of its weight), target.

    Targets share the sum of all sizes by weight; none is above most_passes times its source's
    size, and what is above is shared again by weight among the others.  That is a water level:
    in the order of size / weight, a source is full when the level of those after it would
    overfill it.  One row for each source goes through the windows.
    """
    per = sizes.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("kind", ((F.row_number().over(order) - 1) % len(weights)).cast("int"))
    per = per.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), F.col("kind") + 1).cast("long"))
    cap = most_passes * F.col("source_size")
    level = Window.orderBy((F.col("source_size") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    before = level.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    per = per.select(
        "*",
        F.sum("source_size").over(every).alias("all_size"),
        F.sum("w").over(every).alias("all_w"),
        F.coalesce(F.sum(cap).over(before), F.lit(0)).alias("full_size"),
        F.coalesce(F.sum("w").over(before), F.lit(0)).alias("full_w"),
    )
    full = (F.col("all_size") - F.col("full_size")) * F.col("w") > cap * (F.col("all_w") - F.col("full_w"))
    per = per.withColumn("full", full)
    rest = F.col("all_size") - F.sum(F.when(F.col("full"), cap).otherwise(0)).over(every)
    rest_w = F.col("all_w") - F.sum(F.when(F.col("full"), F.col("w")).otherwise(0)).over(every)
    share = (rest * F.col("w")).cast("double") / rest_w.cast("double")
    return per.select("source", "n_docs", "source_size", "kind", F.when(F.col("full"), cap.cast("double")).otherwise(share).alias("target"))


def when_due(reached: Column, kind: Column, schedules: tuple[tuple[float, float], ...] = SCHEDULES) -> Column:
    """The time at which the schedule's integral a t + (b - a) t^2 / 2 is ``reached`` (0 to 1)."""
    out = F.lit(None).cast("double")
    for i, (a, b) in enumerate(schedules):
        t = reached if a == b else (F.sqrt(F.lit(a * a) + F.lit(2 * (b - a)) * reached) - F.lit(a)) / F.lit(b - a)
        out = F.when(kind == i, t).otherwise(out)
    return out


def mix_sources(docs: DataFrame, keep: tuple[str, ...] = (), weights: tuple[int, ...] = WEIGHTS, schedules: tuple[tuple[float, float], ...] = SCHEDULES, most_passes: int = MOST_PASSES) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, passes, position, and ``keep`` (a name that these have becomes kept_ and the name), in the order of position.

    docs: doc_id, text, source.  taken: words that the mix takes of the document, repeats counted;
    passes: how often it is begun; position: when it is begun first.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mix")
    # kept columns travel under names of their own, and keep theirs in the end but where the result has it
    results = ["doc_id", "source", "size", "source_size", "target", "taken", "passes", "position"]
    held = [f"kept {i}" for i in range(len(keep))]
    kept_names = [f"kept_{c}" if c.lower() in results else c for c in keep]
    sizes = scratch.write(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), *(F.col(c).alias(h) for c, h in zip(keep, held, strict=True))))
    targets = scratch.write(source_targets(sizes, weights, most_passes))
    largest = targets.agg(F.max("n_docs")).first()[0] or 0
    digits = 2
    while largest > ROWS_A_RANGE * 16**digits and digits < 8:
        digits += 1
    mark = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = sizes.select("*", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("stream"), mark.alias("mark")).withColumn("part", F.substring("mark", 1, digits))
    parts = rows.groupBy("stream", "part").agg(F.sum("size").alias("part_size"))
    ahead = Window.partitionBy("stream").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("stream", "part", F.coalesce(F.sum("part_size").over(ahead), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("stream", "part").orderBy("mark", "doc_id", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("ran", F.sum("size").over(inside)).join(parts, ["stream", "part"])
    start = F.col("part_start") + F.col("ran") - F.col("size")
    named = targets.select(F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("stream"), "source_size", "kind", "target")
    rows = rows.withColumn("start", start).join(named, "stream")
    whole = F.floor("target")
    ends = [F.least(F.greatest(whole - F.col("start") - n * F.col("source_size"), F.lit(0)), F.col("size")) for n in range(most_passes)]
    taken, passes = ends[0], F.when(ends[0] > 0, 1).otherwise(0)
    for x in ends[1:]:
        taken, passes = taken + x, passes + F.when(x > 0, 1).otherwise(0)
    out = rows.withColumn("taken", taken.cast("long")).withColumn("passes", passes.cast("int"))
    due = when_due(F.col("start").cast("double") / F.col("target"), F.col("kind"), schedules)
    out = out.withColumn("position", F.when(F.col("taken") > 0, due))
    return out.select("doc_id", "source", "size", "source_size", "target", "taken", "passes", "position", *(F.col(f"`{h}`").alias(c) for c, h in zip(kept_names, held, strict=True))).orderBy(F.col("position").asc_nulls_last(), "doc_id", "size")


ORACLE = """
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT) AS kind FROM d GROUP BY source
), w AS (
  SELECT *, CASE kind WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM s
), f AS (
  SELECT *, sum(source_size) OVER () AS all_size, sum(w) OVER () AS all_w,
    coalesce(sum(3 * source_size) OVER b, 0) AS full_size, coalesce(sum(w) OVER b, 0) AS full_w
  FROM w WINDOW b AS (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), g AS (
  SELECT *, (all_size - full_size) * w > 3 * source_size * (all_w - full_w) AS is_full FROM f
), t AS (
  SELECT source, source_size, kind, CASE WHEN is_full THEN CAST(3 * source_size AS DOUBLE)
    ELSE CAST((all_size - sum(CASE WHEN is_full THEN 3 * source_size ELSE 0 END) OVER ()) * w AS DOUBLE) / CAST(all_w - sum(CASE WHEN is_full THEN w ELSE 0 END) OVER () AS DOUBLE) END AS target
  FROM g
), o AS (
  SELECT d.doc_id, d.source, d.size, t.source_size, t.kind, t.target, CAST(floor(t.target) AS BIGINT) AS whole,
    CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5(CAST(d.doc_id AS VARCHAR)), d.doc_id, d.size ROWS UNBOUNDED PRECEDING) AS BIGINT) - d.size AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), p AS (
  SELECT *, least(greatest(whole - start, 0), size) AS e0, least(greatest(whole - start - source_size, 0), size) AS e1, least(greatest(whole - start - 2 * source_size, 0), size) AS e2,
    CAST(start AS DOUBLE) / target AS u FROM o
)
SELECT doc_id, source, size, source_size, target, CAST(e0 + e1 + e2 AS BIGINT) AS taken,
  CAST((e0 > 0)::INT + (e1 > 0)::INT + (e2 > 0)::INT AS INT) AS passes,
  CASE WHEN e0 + e1 + e2 > 0 THEN CASE kind WHEN 0 THEN (sqrt(2.25e0 + -2.0e0 * u) - 1.5e0) / -1.0e0 WHEN 1 THEN u ELSE (sqrt(0.25e0 + 2.0e0 * u) - 0.5e0) / 1.0e0 END END AS position
FROM p
"""
