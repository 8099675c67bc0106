"""Exact top-k by inner product: an impact-ordered index, read score-at-a-time.

The vectors lie in blocks.  In a block each dimension is a posting list sorted by
component and cut into segments of equal length; a segment's impact for a query is the
largest product that the query's component can have with it.  A query takes the segments
in descending impact, adding products to the accumulators of their members.  A vector's
score is at most its accumulator plus, for each dimension in which it has not been met,
the impact of that dimension's next segment.  Reading stops only when this proves that few
vectors can still enter the query's best k; these possible members are scored exactly, so
the result is exact.  A task carries each query's best k from block to block, which lifts
the bar for later blocks.

Queries go in chunks of ``QUERIES_A_CHUNK``, a job for each, which appends its result to a
table; the index is written once and read for each.

Products are sums of integers below 2^53 for components up to ``NARROW``; rows and queries
with larger ones are scored in integers of any size.

Semantics: a vector that is null or holds a null or non-finite component takes no part, as
query or candidate; shorter vectors count as padded with zeros; an empty vector scores 0.
Scaled components beyond +-2^62 and scores that no long holds stop at the nearest long.
Each row is a query or candidate of its own, also where a vec_id repeats; only the query's own
row is no candidate.  Null ids take no part.  No rows or queries give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumentide.llm.common import Scratch

SCALE = 1024
#: Vectors of one block, segments of a posting list, and segments read between two proofs.
BLOCK, SEGMENTS, STRIDE = 16_384, 4, 24
#: Reading stops once at most this share of a block can still matter.
FEW = 0.1
#: Queries that are broadcast at once: at 64 components of 8 bytes, 2 MB.
QUERIES_A_CHUNK = 4_096
#: Up to it, products of 512 components sum up below 2^53.
NARROW = 1 << 22
_BOUND = 1 << 62
_LONG = (1 << 63) - 1


def scaled(embedding: Column, scale: int = SCALE) -> Column:
    """array<long> of floor(scale * x); null if the vector takes no part."""
    wide = F.transform(embedding, lambda x: x.cast("double"))
    bad = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(wide, lambda x: F.floor(F.greatest(F.least(F.lit(scale) * x, F.lit(float(_BOUND))), F.lit(-float(_BOUND)))).cast("long"))
    return F.when(embedding.isNotNull() & ~F.coalesce(bad, F.lit(False)), whole)


class Block:
    """The index of one block of integer vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, segments: int = SEGMENTS):
        self.ids, self.vectors = ids, vectors
        n, dims = vectors.shape
        self.segments = max(1, min(segments, n))
        self.cuts = np.linspace(0, n, self.segments + 1).astype(np.int64)
        # posting lists one after the other, so that a segment is one run of memory
        columns = np.ascontiguousarray(vectors.T)
        self.order = np.argsort(-columns, axis=1, kind="stable")
        self.sorted = np.take_along_axis(columns, self.order, axis=1)
        self.top, self.low = self.sorted[:, self.cuts[:-1]].T, self.sorted[:, self.cuts[1:] - 1].T
        self.place = np.empty((n, dims), np.int8)
        level = np.repeat(np.arange(self.segments, dtype=np.int8), np.diff(self.cuts))
        for d in range(dims):
            self.place[self.order[d], d] = level

    def search(self, query: np.ndarray, own: int, k: int, floor: int | None) -> np.ndarray:
        """Rows whose score may be among the best k, given that floor is already reached by k others."""
        n, dims = self.vectors.shape
        if n <= 4 * k:
            return np.arange(n)
        # impact[s, d]: of the s-th segment to be read in dimension d
        up = query > 0
        impact = np.where(up, self.top * query, (self.low * query)[::-1])
        after = np.vstack([impact[1:], np.zeros((1, dims), np.int64)])
        seg, dim = np.unravel_index(np.argsort(-impact, axis=None, kind="stable"), impact.shape)
        total = np.zeros(n, np.int64)
        read = np.zeros(dims, np.int8)
        bound = impact[0].copy()
        turn = np.where(up, self.place, np.int8(self.segments - 1) - self.place)  # when a vector is met in each dimension
        for i in range(0, len(seg), STRIDE):
            for s, d in zip(seg[i : i + STRIDE].tolist(), dim[i : i + STRIDE].tolist(), strict=True):
                at = s if up[d] else self.segments - 1 - s
                span = slice(self.cuts[at], self.cuts[at + 1])
                total[self.order[d, span]] += self.sorted[d, span] * query[d]
                read[d] = s + 1
                bound[d] = after[s, d]
            if (i // STRIDE % 2 == 0 or i < 3 * STRIDE) and len(seg) > 4 * STRIDE:
                continue
            rest = (turn >= read).astype(np.float32) @ bound.astype(np.float32)
            most = total + rest.astype(np.float64) + (1 + float(np.abs(bound).sum()) * 2.0**-15)  # more than sums of up to 512 floats can be off
            bar = self._bar(query, own, k, total, floor)
            if bar is None:
                continue
            left = np.flatnonzero(most > bar)
            if len(left) <= max(4 * k, FEW * n):
                return left
        return np.arange(n) if floor is None else np.flatnonzero(total >= floor)

    def _bar(self, query: np.ndarray, own: int, k: int, total: np.ndarray, floor: int | None) -> int | None:
        """A score that k candidates are proved to reach."""
        likely = np.argpartition(-total, 2 * k)[: 2 * k]
        exact = np.sort((self.vectors[likely] @ query)[self.ids[likely] != own])[::-1]
        here = int(exact[k - 1]) if len(exact) >= k else None
        return max((x for x in (here, floor) if x is not None), default=None)


def _padded(lists: pa.ListArray, dims: int) -> np.ndarray:
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    if len(lists) and (lengths == dims).all():
        return flat.reshape(len(lists), dims)
    out = np.zeros((len(lists), dims), np.int64)
    keep = np.arange(dims) < lengths[:, None]
    out[keep] = flat
    return out


def wide_scores(matrix: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact inner products in Python's integers, held to what a long can hold."""
    return np.array([min(max(int(x), -_LONG - 1), _LONG) for x in matrix.astype(object) @ query.astype(object)], np.int64)


def top_k(vectors: DataFrame, queries: Column, k: int = 10, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest scores of each row for which ``queries`` holds."""
    spark = vectors.sparkSession
    scratch = Scratch(spark, "topk")
    base = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), scaled(F.col(embedding), scale).alias("v"), F.coalesce(queries, F.lit(False)).alias("asks")).where("vec_id is not null and v is not null")
    index = scratch.write(base.withColumn("row", F.monotonically_increasing_id()))  # written, so a row's number stays
    facts = index.agg(F.max(F.size("v")).alias("dims"), F.count(F.when(F.col("asks"), 1)).alias("n")).first()
    dims, chunks = facts["dims"] or 0, -(-(facts["n"] or 0) // QUERIES_A_CHUNK)
    schema = "query_row long, query_id long, vec_id long, score long"
    parts = []
    for c in range(chunks):
        chunk = index.where(F.col("asks") & (F.pmod(F.xxhash64("row"), F.lit(chunks)) == c)).select("row", "vec_id", "v").toArrow()
        sent = spark.sparkContext.broadcast((chunk["row"].to_numpy(), chunk["vec_id"].to_numpy(), _padded(chunk["v"].combine_chunks(), dims)))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            asks, names, rows = sent.value
            # rows, scores and ids of each query's best so far
            held = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in asks]
            narrow_query = (np.abs(rows) <= NARROW).all(axis=1) & (dims <= 512)

            def keep(i: int, row: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
                other = row != asks[i]
                if len(held[i][0]) >= k:
                    other &= scores >= held[i][1][-1]
                row, scores, ids = (np.r_[h, x[other]] for h, x in zip(held[i], (row, scores, ids), strict=True))
                order = np.lexsort((row, ids, ~scores))[:k]  # ~x falls as x rises, and no long overflows
                held[i] = row[order], scores[order], ids[order]

            def take(row: np.ndarray, ids: np.ndarray, matrix: np.ndarray) -> None:
                narrow = (np.abs(matrix) <= NARROW).all(axis=1)
                plain, whole = ids[narrow], bool(narrow.all())
                block = Block(row[narrow], matrix[narrow]) if narrow.any() else None
                for i, (own, q) in enumerate(zip(asks.tolist(), rows, strict=True)):
                    if not narrow_query[i]:
                        keep(i, row, ids, wide_scores(matrix, q))
                        continue
                    if block is not None:
                        scores = held[i][1]
                        left = block.search(q, own, k, int(scores[-1]) if len(scores) >= k else None)
                        keep(i, block.ids[left], plain[left], block.vectors[left] @ q)
                    if not whole:
                        keep(i, row[~narrow], ids[~narrow], wide_scores(matrix[~narrow], q))

            waiting, n = [], 0
            for batch in batches:
                cols = batch.column(0).to_numpy(), batch.column(1).to_numpy(), _padded(batch.column(2), dims)
                for i in range(0, len(cols[0]), BLOCK):
                    waiting.append([x[i : i + BLOCK] for x in cols])
                    n += len(waiting[-1][0])
                    if n >= BLOCK:
                        take(*(np.concatenate(x) for x in zip(*waiting, strict=True)))
                        waiting, n = [], 0
            if n:
                take(*(np.concatenate(x) for x in zip(*waiting, strict=True)))
            sizes = np.array([len(h[0]) for h in held], np.int64)
            if sizes.sum():
                arrays = [np.repeat(asks, sizes), np.repeat(names, sizes), np.concatenate([h[2] for h in held]), np.concatenate([h[1] for h in held])]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=["query_row", "query_id", "vec_id", "score"])

        parts.append(scratch.write(index.select("row", "vec_id", "v").mapInArrow(run, schema)))
        sent.destroy()
    scratch.drop(index)
    found = spark.read.schema(schema).parquet(*(x._scratch_path for x in parts)) if parts else spark.createDataFrame([], schema)
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND NOT list_bool_or(list_transform(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x)))
), c AS (
  SELECT vec_id, unnest(v) AS x, unnest(range(len(v))) AS i FROM v
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score FROM c q JOIN c ON q.i = c.i AND q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0 GROUP BY 1, 2
)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10
"""
