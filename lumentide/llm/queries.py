"""The operators bound to the driver's tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumentide.llm import chat_format, decontamination, html_extraction, line_dedup, ngram_join, pii, source_mixing, token_counts, topk_search, toxicity
from lumentide.llm.common import table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.fuzzy_lines(table(spark, sf_dir, "documents"), least=1)


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = chat_format.transcripts(table(spark, sf_dir, "conversations"))
    model = chat_format.train(parts.where(F.crc32(F.col("conv").cast("binary")) % 5 != 0))
    return chat_format.parse_transcripts(parts, model)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract(table(spark, sf_dir, "pages"))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mixing.mix_sources(table(spark, sf_dir, "documents"))


def op9_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_chat_format": op2_chat_format,
    "op3_pii": op3_pii,
    "op4_ngram_join": op4_ngram_join,
    "op5_toxicity": op5_toxicity,
    "op6_token_counts": op6_token_counts,
    "op7_html_extraction": op7_html_extraction,
    "op8_source_mixing": op8_source_mixing,
    "op9_topk_search": op9_topk_search,
    "op10_decontamination": op10_decontamination,
    "pipeline": pipeline,
}

ORACLE: dict[str, str] = {
    "op8_source_mixing": source_mixing.ORACLE,
    "op9_topk_search": topk_search.ORACLE,
}
