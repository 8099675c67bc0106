"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; the negatives are unknown, so the others count
as unlabelled.  With the class prior p, the risk of a classifier on negatives is its negative
risk on unlabelled text less p times its negative risk on positives; where that estimate falls
below zero the classifier has begun to fit the positives among the unlabelled, and the step is
taken back up instead (the non-negative estimator).

Features are hashed words and word beginnings of several lengths, in logarithms of their
rates in the text; those that stand out among the positives are kept, and a linear classifier
over them is trained in numpy on the driver from bounded samples.  Scoring is one narrow pass.

Semantics: null and empty texts have no features and get the score of the bias; of a doc_id
with several labels one that says toxic suffices; without positives every score is the prior's
floor.  Labels train only; no label, language, source or id is a feature.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumentide.llm.common import Scratch, groups_of, mix64, utf8_parts
from lumentide.llm.shingling import PIECE, _power_tables

#: Bounds of the samples that the classifier is fitted on.
MOST_POSITIVES, MOST_UNLABELLED = 4_000, 12_000
BUCKET_BITS = 20
FEATURES = 512
#: A feature is kept if so many positives have it, with so high a z score against the unlabelled.
LEAST_POSITIVES, LEAST_Z = 4, 4.0
#: Lengths in bytes of the word beginnings that are features of longer words.
BEGINNINGS = (3, 4, 5, 6, 7, 8, 10)
STEPS, RATE, DECAY = 300, 0.05, 1.5e-3
PRIOR_FLOOR = 1e-3

_LETTER = np.zeros(256, bool)
_LETTER[48:58] = _LETTER[65:91] = _LETTER[97:123] = True
_LETTER[128:] = True


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _lower(data: np.ndarray) -> np.ndarray:
    """ASCII and Latin-1 capitals as small letters, on UTF-8 bytes."""
    out = data.copy()
    out[(data >= 65) & (data <= 90)] += 32
    wide = np.zeros(len(data), bool)
    wide[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    out[wide] += 32
    return out


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, bucket) of every word and word beginning of the texts between the offsets, and the words of each text."""
    piece = _lower(data[offsets[0] : offsets[-1]])
    bounds = offsets - offsets[0]
    if not len(piece):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
    power, inverse = _power_tables(len(piece) + 1)
    first = np.zeros(len(piece) + 1, bool)
    first[bounds[:-1]] = True
    first = first[:-1]
    letter = _LETTER[piece]
    begins, ends = letter.copy(), letter.copy()
    begins[1:] &= ~letter[:-1] | first[1:]
    ends[:-1] &= ~letter[1:] | first[1:]
    s, e = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    owner = np.searchsorted(bounds, s, "right") - 1
    with np.errstate(over="ignore"):
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum((piece.astype(np.uint64) + np.uint64(1)) * power[: len(piece)], out=sums[1:])
        at = sums[s]
        scale = inverse[s]
        hashes, owners = [(sums[e] - at) * scale], [owner]
        for n in BEGINNINGS:
            long = e - s > n
            hashes.append((sums[s[long] + n] - at[long]) * scale[long] + np.uint64(n) * np.uint64(0x9E3779B97F4A7C15))
            owners.append(owner[long])
    buckets = (mix64(np.concatenate(hashes)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    return np.concatenate(owners), buckets, np.bincount(owner, minlength=len(offsets) - 1)


def feature_runs(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first text, end, text within, bucket, words of each text) for runs of the texts of a column."""
    data, offsets = utf8_parts(column)
    for i, j in groups_of(offsets, PIECE):
        yield i, j, *features(data, offsets[i : j + 1])


@dataclass
class Model:
    place: np.ndarray  # feature of each bucket, -1 if none
    weights: np.ndarray
    bias: float

    def logits(self, text: np.ndarray, bucket: np.ndarray, words: np.ndarray) -> np.ndarray:
        at, f, value = rated(self.place, text, bucket, words)
        return self.bias + np.bincount(at, self.weights[f] * value, minlength=len(words))


def rated(place: np.ndarray, text: np.ndarray, bucket: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, value) of the kept features; the value grows with the rate in a thousand words."""
    f = place[bucket]
    keep = f >= 0
    key, times = np.unique(text[keep] * (len(place) + 1) + f[keep], return_counts=True)
    at = key // (len(place) + 1)
    return at, key % (len(place) + 1), np.log1p(1000 * times / words[at]) / 4


def select(counts: tuple[np.ndarray, np.ndarray, np.ndarray], positives: int, unlabelled: int, most: int = FEATURES) -> np.ndarray:
    """Bucket -> feature: the buckets that stand out most among the positives by a z score."""
    bucket, p, u = counts
    place = np.full(1 << BUCKET_BITS, -1, np.int64)
    if positives and unlabelled:
        share, base = p / positives, u / unlabelled
        z = (share - base) / np.sqrt((base + 2 / unlabelled) * (1 / positives + 1 / unlabelled))
        z[p < LEAST_POSITIVES] = 0
        order = np.argsort(-z, kind="stable")[:most]
        order = order[z[order] > LEAST_Z]
        place[bucket[order]] = np.arange(len(order))
    return place


def fit(x: np.ndarray, positive: np.ndarray, prior: float, steps: int = STEPS, rate: float = RATE, decay: float = DECAY) -> tuple[np.ndarray, float]:
    """Weights and bias by Adam on the non-negative PU risk with the logistic loss."""
    xp, xu = x[positive], x[~positive]
    w = np.zeros(x.shape[1] + 1)
    w[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    for t in range(1, steps + 1):
        small = w[:-1].astype(x.dtype)
        zp, zu = (xp @ small).astype(float) + w[-1], (xu @ small).astype(float) + w[-1]
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        gp = -prior * sig(-zp) / len(zp)
        gn_u, gn_p = sig(zu) / len(zu), -prior * sig(zp) / len(zp)
        if negative < 0:  # step back up
            gp, gu = -gn_p, -gn_u
        else:
            gp, gu = gp + gn_p, gn_u
        g = np.r_[gp.astype(x.dtype) @ xp + gu.astype(x.dtype) @ xu, gp.sum() + gu.sum()]
        g[:-1] += decay * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:-1], float(w[-1])


def train(docs: DataFrame, labels: DataFrame, positives: int = MOST_POSITIVES, unlabelled: int = MOST_UNLABELLED) -> Model:
    """docs: doc_id, text; labels: doc_id, toxic.  Held-out rows train nothing."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "toxic")
    known = labels.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg((F.max("toxic") == 1).alias("toxic"))
    share = known.agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    prior = float(min(0.5, max(PRIOR_FLOOR, share or PRIOR_FLOOR)))
    toxic = known.where("toxic").select("doc_id")
    ids = docs.select("doc_id").where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    by_hash = F.xxhash64("doc_id")
    p = ids.join(toxic, "doc_id", "left_semi").orderBy(by_hash, "doc_id").limit(positives).distinct().withColumn("positive", F.lit(True))
    u = ids.join(toxic, "doc_id", "left_anti").orderBy(by_hash, "doc_id").limit(unlabelled).distinct().withColumn("positive", F.lit(False))
    drawn = scratch.write(p.unionByName(u))  # at most positives + unlabelled ids, so it may be broadcast
    # one row of each drawn id, so that rows are bounded as ids are
    sample = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id").groupBy("doc_id", "positive").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    sample = scratch.write(sample.select("positive", "text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 << BUCKET_BITS), np.int64)
        for batch in batches:
            positive = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for i, j, text, bucket, _ in feature_runs(batch.column(1)):
                own = positive[i:j]
                seen = np.unique(text << BUCKET_BITS | bucket)
                text, bucket = seen >> BUCKET_BITS, seen & ((1 << BUCKET_BITS) - 1)
                for side in (0, 1):
                    total[side] += np.bincount(bucket[own[text] == side], minlength=1 << BUCKET_BITS)
        some = np.flatnonzero(total.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[1, some]), pa.array(total[0, some])], names=["bucket", "p", "u"])

    sizes = {r["positive"]: r["n"] for r in sample.groupBy("positive").agg(F.count("*").alias("n")).collect()}
    counts = sample.select("positive", "text").mapInArrow(count, "bucket long, p long, u long").groupBy("bucket").agg(F.sum("p").alias("p"), F.sum("u").alias("u")).where("p >= 3").toArrow()
    place = select(tuple(counts[c].to_numpy() for c in ("bucket", "p", "u")), sizes.get(True, 0), sizes.get(False, 0))
    kept = int(place.max()) + 1
    floor = float(np.log(PRIOR_FLOOR / (1 - PRIOR_FLOOR)))
    if not kept or not sizes.get(True) or not sizes.get(False):
        return Model(np.full(1 << BUCKET_BITS, -1, np.int64), np.zeros(1), floor)
    sent = spark.sparkContext.broadcast(place.astype(np.int32))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            f, v = [], []
            for i, j, text, bucket, words in feature_runs(batch.column(1)):
                at, feature, value = rated(sent.value, text, bucket, words)
                cuts = np.searchsorted(at, np.arange(1, j - i))
                f += np.split(feature, cuts)
                v += np.split(value.astype(np.float32), cuts)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(f, pa.list_(pa.int32())), pa.array(v, pa.list_(pa.float32()))], names=["positive", "f", "v"])

    got = sample.select("positive", "text").mapInArrow(rows, "positive boolean, f array<int>, v array<float>").toArrow()
    lengths = got["f"].combine_chunks().value_lengths().to_numpy()
    x = np.zeros((len(lengths), kept), np.float32)
    x[np.repeat(np.arange(len(lengths)), lengths), got["f"].combine_chunks().flatten().to_numpy()] = got["v"].combine_chunks().flatten().to_numpy()
    # rows in an order of their own, so that reruns sum alike
    positive = got["positive"].to_numpy().astype(bool)
    order = np.lexsort((x @ np.arange(1, kept + 1), x.sum(axis=1), positive))
    weights, bias = fit(x[order], positive[order], prior)
    scratch.drop(sample, drawn)
    return Model(place, weights, bias)


def _logits(use: Model, column: pa.Array) -> np.ndarray:
    return np.concatenate([use.logits(text, bucket, words) for _, _, text, bucket, words in feature_runs(column)] or [np.zeros(0)])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted of every row of docs (doc_id, text)."""
    sent = docs.sparkSession.sparkContext.broadcast(Model(model.place.astype(np.int16), model.weights, model.bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = _logits(sent.value, batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(z, -40, 40))))], names=["doc_id", "score"])

    out = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """docs less each row whose text is predicted toxic, whatever its doc_id."""
    sent = docs.sparkSession.sparkContext.broadcast(Model(model.place.astype(np.int16), model.weights, model.bias))
    body, names = docs.columns.index("text"), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = _logits(sent.value, batch.column(body))
            yield pa.RecordBatch.from_arrays(batch.columns, names=names).filter(pa.array(1 / (1 + np.exp(-np.clip(z, -40, 40))) < 0.5))

    return docs.mapInArrow(run, docs.schema)
