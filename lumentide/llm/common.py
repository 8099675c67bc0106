"""Helpers shared by the operators: tables, Arrow text access."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumentide.stored import Scratch, shared_dir  # noqa: F401

#: Arrow batches handed to Python stay under this, however long the texts are.
ARROW_BATCH_BYTES = "8m"

#: A broadcast side may have so many rows of 8 to 16 bytes; beyond it, joins shuffle.
BROADCAST_ROWS = 1_000_000


def tune(spark: SparkSession) -> SparkSession:
    """Bounds the memory of Arrow batches and lets workers import this package; call it before planning a Python stage."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BATCH_BYTES)
    root = Path(__file__).resolve().parents[2]
    seen = [Path(p).resolve() for p in [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)] if p]
    if root not in seen and not getattr(spark.sparkContext, "_lumentide_sent", False):
        folder = tempfile.mkdtemp(prefix="lumentide-")
        spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/lumentide", "zip", root, "lumentide"))
        spark.sparkContext._lumentide_sent = True
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def few_enough(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether df has at most ``rows`` rows: the check that stands before each broadcast."""
    return df.limit(rows + 1).count() <= rows


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of df has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def with_row_ids(docs: DataFrame, name: str) -> DataFrame:
    """docs with ``name``: the doc_id where it is there and no other row has it, else a hash of the row's id and text from 2^62 on.

    So rows without doc_id and rows that share one are told apart, and rows repeated as a whole have one id.
    """
    several = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    made = F.xxhash64("doc_id", "text").bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    odd = F.col("doc_id").isNull()
    if not several.limit(1).count():
        return docs.withColumn(name, F.when(odd, made).otherwise(F.col("doc_id").cast("long")))
    mark = free_name(docs, "several")
    several = several.withColumn(mark, F.lit(True))
    both = docs.join(F.broadcast(several) if few_enough(several) else several, "doc_id", "left")
    return both.withColumn(name, F.when(odd | F.col(mark).isNotNull(), made).otherwise(F.col("doc_id").cast("long"))).select(*docs.columns, name)


def semi_join(big: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows of big whose key is in keys (unique): a broadcast behind a size check, else a shuffle."""
    return big.join(F.broadcast(keys) if few_enough(keys) else keys, on, "left_semi")


# --- Arrow columns ---------------------------------------------------------------------------


def utf8_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls count as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data, offsets


def groups_of(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs [i, j) of texts with about ``most`` bytes together; a longer text stands alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def long_list(values: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """list<long> column from flat values and the length of each row's list."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int64, copy=False)))


def distinct(values: np.ndarray) -> np.ndarray:
    """The sorted distinct values; a sort, since hashing them is slower for sets of this size."""
    values = np.sort(values)
    return values[np.r_[True, values[1:] != values[:-1]]] if len(values) else values


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Values that two sorted distinct arrays share: a stable sort merges the two runs."""
    both = np.concatenate((a, b))
    both.sort(kind="stable")
    return int((both[1:] == both[:-1]).sum())


# --- hashing -----------------------------------------------------------------------------------


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, elementwise on uint64."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))
