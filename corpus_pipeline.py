"""The corpus pipeline: five stages from raw documents to a training mix.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and
read again as the next one's docs.  All but the last return the columns of ``documents``.

* toxicity: a classifier trained on the labels scores every row; those it rejects go.
* line_dedup: of alike lines the first stays; a row left without text goes.
* near_duplicates: of each component of documents with similar word shingles the first stays.
* decontamination: rows that hold a window of a benchmark item go.
* mixing: the last stage gives each document its words taken and its training position.

Every row is decided by itself, also where it has no doc_id or shares one: the first and fourth
stage filter rows, and the second and third know such rows by a hash of id and text; of rows
repeated as a whole one stays after the third stage.  Null and empty texts pass all stages;
very long texts are handled whole.  Columns of any other name pass through, whatever they are
called; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumentide.llm import decontamination, line_dedup, ngram_join, source_mixing, toxicity
from lumentide.llm.common import Scratch, few_enough, free_name, table, tune, with_row_ids

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tune(spark)
    return toxicity.without_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of rows without doc_id take part by a hash of their text, after those of all others."""
    tune(spark)
    row = free_name(docs, "row")
    named = with_row_ids(docs, row)
    given = named.select(F.col(row).alias("doc_id"), "text")
    lines = line_dedup.fuzzy_lines(given)
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    own = free_name(docs, "own_id")
    whole = named.select(F.col(row).alias("doc_id"), "text", F.col("doc_id").alias(own), *rest)
    out = line_dedup.without_lines(whole, lines).select(*(F.col(own).alias(c) if c == "doc_id" else F.col(c) for c in docs.columns))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tune(spark)
    row = free_name(docs, "row")
    named = with_row_ids(docs, row)
    parts = ngram_join.near_duplicates(named.select(F.col(row).alias("doc_id"), "text"))
    gone = parts.where("component_id <> doc_id").select(F.col("doc_id").alias(row)).distinct()
    left = named.join(F.broadcast(gone) if few_enough(gone) else gone, row, "left_anti")
    # rows with an id that is theirs alone stay as they are; of those repeated as a whole one does
    alone = F.coalesce(F.col(row) == F.col("doc_id"), F.lit(False))
    others = left.where(~alone)
    if others.limit(1).count():
        left = left.where(alone).unionByName(others.dropDuplicates([row]))
    return left.select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tune(spark)
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    tune(spark)
    return source_mixing.mix_sources(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("mixing", mix),
]

#: A trained classifier and MinHash decide the first stages, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the table ``documents``."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs, before = scratch.write(stage(spark, docs, sf_dir)), docs
        scratch.drop(before)
    return docs
