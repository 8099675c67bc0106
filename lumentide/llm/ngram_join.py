"""N-gram Jaccard self-join by parity sketches.

A document's set (distinct shingles of five words) is XOR-hashed into a bit sketch: each
shingle toggles the 64 bits of its hash in one of k words of the sketch.  A shingle that only
one of two sets has changes one word, so the number of differing words is at most the
symmetric difference, which a similarity of t bounds: sets of sizes a and b share at least
(a + b) t / (1 + t) shingles.  By the pigeonhole principle the documents agree in other words.

Size bands grow by four; a pair meets in the band of its smaller set, so a document also
sketches itself for the band below if a partner can be there.  The sketch is sparse (SPARSE
words for each shingle of the band's smallest set): few shingles share a word, and a word that
stands for one shingle differs only if the partner lacks the shingle, or holds another in the
same word.  So of a document's non-empty words at most those of its shingles that the partner
lacks differ, besides as many as shingles share words (``slack``; a set with more of them
than the band allows shows its shingles alone, and finds those of its partner alone or not).  It is enough that a document
shows one more than that of its words in an order that all documents share: of two linked
documents the first word that they have in common is among those of both, and its place in
either tells whether they can still link (``linking.may_link``).  The order goes by how
frequent a word's rarest shingle is, the frequent ones last, so a passage that many documents
share brings few candidates.  Candidates whose bit sketches differ in more bits than linked sets
can are dropped, the others are checked exactly, and large groups of them by pivots and by the
words in an order of their own (``linking``), so no link is lost and no group is expanded into pairs.

Semantics: a null or empty text has an empty set and links with nothing; a null doc_id keeps
its row and has no component; rows of one doc_id are one document.  Equal sets are linked by
their hashes (128 bits), and one document of them stands for all in the join.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumentide.llm.common import Scratch, common, distinct, few_enough, long_list, mix64, semi_join, utf8_parts
from lumentide.llm.linking import linked_components
from lumentide.llm.shingling import shingle_hashes

#: Shingle hashes of each text of a column.
Hashes = Callable[[pa.Array], Iterable[np.ndarray]]

WIDTH = 5
#: Similarity in hundredths: linked if 100 * intersection >= SIMILAR * union.
SIMILAR = 75
#: Shingles held to be frequent: seen so often, at most so many (the most frequent first).
#: They only order sketch words; any choice gives the same links.
FREQUENT, MOST_FREQUENT = 16, 262_144
#: A task reports shingles that it sees so often among so many.
LOCAL_TIMES, LOCAL_SHINGLES = 2, 1 << 22
#: Sets that a task remembers, so as to sketch equal ones once.
REMEMBERED = 500_000
#: Sketch words for each shingle of the smallest set of a band.
SPARSE = 1 << 14
_C = mix64(np.arange(101, 105, dtype=np.uint64))


def word_shingles(width: int) -> Hashes:
    return lambda texts: shingle_hashes(*utf8_parts(texts), width)


def frequent_shingles(texts: DataFrame, hashes: Hashes, times: int = LOCAL_TIMES, least: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of shingles seen ``least`` times and the magnitude of each: local counts, of ``times`` in a task, summed in Spark; bounded by MOST_FREQUENT."""
    least = FREQUENT if least is None else least
    most = LOCAL_SHINGLES if times > 1 else LOCAL_SHINGLES >> 4  # of all counts there are as many rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def counted():
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            often = counts >= times
            return pa.RecordBatch.from_arrays([pa.array(values[often].view(np.int64)), pa.array(counts[often])], names=["h", "n"])

        for batch in batches:
            for s in hashes(batch.column(0)):
                held.append(s)
                n += len(s)
                if n >= most:
                    yield counted()
                    held, n = [], 0
        if n:
            yield counted()

    counts = texts.mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    got = counts.orderBy(F.col("n").desc(), "h").limit(MOST_FREQUENT).toArrow()
    hashes = got["h"].to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], np.minimum(2 * np.log2(np.maximum(got["n"].to_numpy()[order], 1)), 63).astype(np.uint8)


def _slack(band: int) -> int:
    """How many of a set's shingles may share a word in a band before it shows them alone."""
    return 4 ** (band + 1) // 2048


def sketch_words(sets: np.ndarray, frequent: np.ndarray, band: int, least: int, similar: int = SIMILAR) -> np.ndarray:
    """Hashes of the sketch words that a set shows in a band to partners of ``least`` shingles and more, in order."""
    n = len(sets)
    values = mix64(sets ^ _C[0])
    block = (sets >> np.uint64(8)) & np.uint64(SPARSE * 4**band - 1)
    order = np.argsort(block)
    block, words, late = block[order], values[order], frequent[order]
    fresh = np.r_[True, block[1:] != block[:-1]]
    if not fresh.all():
        starts = np.flatnonzero(fresh)
        sizes = np.diff(np.r_[starts, n])
        if sizes[sizes > 1].sum() <= _slack(band):
            block, words, late = block[starts], np.bitwise_xor.reduceat(words, starts), np.minimum.reduceat(late, starts)
    with np.errstate(over="ignore"):
        words = mix64(words ^ mix64(block * _C[1] + np.uint64(band) * _C[2]))
    # shingles that the smallest partner lacks, those in shared words, and one more
    show = n - -(-similar * (n + least) // (100 + similar)) + _slack(band) + 1
    rank = (words >> np.uint64(6)) | (late.astype(np.uint64) << np.uint64(58))
    if show < len(words):
        some = np.argpartition(rank, show - 1)[:show]
        words, rank = words[some], rank[some]
    return words[np.argsort(rank)]


def shown_in_bands(sets: np.ndarray, frequent: np.ndarray, similar: int = SIMILAR) -> list[tuple[int, np.ndarray]]:
    """(slack, words in order) of a set, in its own band and, where a partner can be there, the one below."""
    n = len(sets)
    band = (n.bit_length() - 1) // 2
    least = -(-n * similar // 100)  # the smallest partner
    out = [(_slack(band), sketch_words(sets, frequent, band, max(least, 4**band), similar))]
    if least < 4**band:
        out.append((_slack(band - 1), sketch_words(sets, frequent, band - 1, least, similar)))
    return out


def shown_words(sets: np.ndarray, frequent: np.ndarray, similar: int = SIMILAR) -> np.ndarray:
    """All sketch words that a set shows, over the bands where a partner can be."""
    return np.concatenate([words for _, words in shown_in_bands(sets, frequent, similar)])


def magnitudes(sets: np.ndarray, frequent: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """How frequent each shingle of a set is; 0 for those not held to be frequent."""
    heavy, magnitude = frequent
    if not len(heavy):
        return np.zeros(len(sets), np.uint8)
    at = np.minimum(np.searchsorted(heavy, sets), len(heavy) - 1)
    return np.where(heavy[at] == sets, magnitude[at], np.uint8(0))


def parity_bits(sets: np.ndarray) -> np.ndarray:
    """The set's bit sketch: 2 * 4^(band + 1) bits (64 at least), each the parity of the shingles that hash to it."""
    bits = max(64, 2 * 4 ** ((len(sets).bit_length() - 1) // 2 + 1))
    odd = np.bincount((mix64(sets ^ _C[3]) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


def within_hamming(pairs: DataFrame, nodes: DataFrame, similar: int = SIMILAR) -> DataFrame:
    """The pairs (a, b) whose bit sketches differ in no more bits than linked sets can.  nodes: node, n, bits.

    The shorter sketch is met by the other one folded: its parts XORed are the sketch of fewer bits.
    """
    both = pairs
    for side in ("a", "b"):
        both = both.join(nodes.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}"), F.col("bits").alias(f"bits_{side}")), side)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            sides = []
            for column in (batch.column(4), batch.column(5)):
                column = column.flatten() if isinstance(column, pa.ChunkedArray) else column
                starts = column.offsets.to_numpy()
                sides.append((column.values.to_numpy().view(np.uint64), starts[:-1], np.diff(starts)))
            keep = np.zeros(len(n), bool)
            kinds, which = np.unique(np.stack((sides[0][2], sides[1][2])), axis=1, return_inverse=True)
            for kind in range(kinds.shape[1]):
                rows = np.flatnonzero(which.ravel() == kind)
                words = int(kinds[:, kind].min())
                for at in range(0, len(rows), 1024):
                    part = rows[at : at + 1024]
                    apart = np.zeros((len(part), words), np.uint64)
                    for values, starts, lengths in sides:
                        whole = values[starts[part][:, None] + np.arange(lengths[part[0]])]
                        apart ^= np.bitwise_xor.reduce(whole.reshape(len(part), -1, words), axis=1)
                    keep[part] = np.bitwise_count(apart).sum(axis=1) * (100 + similar) <= n[part] * (100 - similar)
            mask = pa.array(keep)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])

    return both.select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(run, "a long, b long")


def sketches(docs: DataFrame, frequent: tuple[np.ndarray, np.ndarray], hashes: Hashes, similar: int = SIMILAR) -> DataFrame:
    """doc_id, n, h1, h2 (together the set's identity), and words, which are left out if the task has shown an equal set.

    own: how many of the words are of the set's own band; the slack of their places, and of those of the band below;
    bits: the set's bit sketch, where there are words.
    """
    sent = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[tuple[int, int]] = set()
        names = ["n", "h1", "h2", "own", "slack", "slack_below"]
        for batch in batches:
            rows, words, lengths, bits, many = [], [], [], [], []
            for s in hashes(batch.column(1)):
                u = distinct(s)
                with np.errstate(over="ignore"):
                    one, two = mix64(u).sum(dtype=np.uint64), np.bitwise_xor.reduce(mix64(u ^ _C[3]))
                row = [len(u), int(one.view(np.int64)) if len(u) else 0, int(two.view(np.int64)) if len(u) else 0, 0, 0, 0]
                shown, sketch = [], u[:0]
                if len(u) and (row[1], row[2]) not in known:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known.add((row[1], row[2]))
                    shown = shown_in_bands(u, magnitudes(u, sent.value), similar)
                    sketch = parity_bits(u)
                    row[3:] = [len(shown[0][1]), shown[0][0], shown[-1][0]]
                rows.append(row)
                words += [w for _, w in shown]
                lengths.append(sum(len(w) for _, w in shown))
                bits.append(sketch)
                many.append(len(sketch))
            lists = [long_list((np.concatenate(v) if v else np.zeros(0, np.uint64)).view(np.int64), np.array(c, np.int64)) for v, c in ((words, lengths), (bits, many))]
            table = np.array(rows, np.int64).reshape(len(rows), 6)
            arrays = [batch.column(0), *(pa.array(np.ascontiguousarray(table[:, i])) for i in range(6)), *lists]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", *names, "words", "bits"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n long, h1 long, h2 long, own long, slack long, slack_below long, words array<long>, bits array<long>")


def check_pairs(pairs: DataFrame, texts: DataFrame, width: int = WIDTH, similar: int = SIMILAR) -> DataFrame:
    """The pairs (a, b) of nodes whose texts (node, text) have similar sets."""
    both = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a").join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            sides = []
            for ids, column in ((a, batch.column(2)), (b, batch.column(3))):
                encoded = column.dictionary_encode()  # a pivot's text is hashed once a batch
                sets = [distinct(s) for s in shingle_hashes(*utf8_parts(encoded.dictionary), width)]
                sides.append((encoded.indices.to_numpy(), sets))
            keep = np.zeros(len(a), bool)
            for i, (x, y) in enumerate(zip(sides[0][0].tolist(), sides[1][0].tolist(), strict=True)):
                p, q = sides[0][1][x], sides[1][1][y]
                if min(len(p), len(q)) * 100 < similar * max(len(p), len(q)) or not len(p):
                    continue
                both = common(p, q)
                keep[i] = 100 * both >= similar * (len(p) + len(q) - both)
            yield pa.RecordBatch.from_arrays([pa.array(a[keep]), pa.array(b[keep])], names=["a", "b"])

    return both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def key_rows(made: DataFrame) -> DataFrame:
    """key, node, size and pos (place of the key in the set's order, less the slack) of sketches."""
    place = F.when(F.col("i") < F.col("own"), F.col("i") - F.col("slack")).otherwise(F.col("i") - F.col("own") - F.col("slack_below"))
    rows = made.select("doc_id", "n", "own", "slack", "slack_below", F.posexplode("words").alias("i", "key"))
    return rows.select("key", F.col("doc_id").alias("node"), F.col("n").alias("size"), place.alias("pos"))


def finer_keys(nodes: DataFrame, hashes: Hashes, similar: int = SIMILAR) -> DataFrame:
    """key, node, size, pos of texts (node, text) in the order that the counts among just these texts give, all of which are counted."""
    counts = frequent_shingles(nodes.select("text"), hashes, times=1, least=2)
    return key_rows(sketches(nodes.select(F.col("node").alias("doc_id"), "text"), counts, hashes, similar))


def near_duplicates(docs: DataFrame, width: int = WIDTH, similar: int = SIMILAR) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id that links reach, itself included) of every row.

    docs: doc_id, text.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "ngram")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    hashes = word_shingles(width)
    frequent = frequent_shingles(docs.select("text"), hashes)
    made = scratch.write(sketches(docs, frequent, hashes, similar))
    real = made.where("n > 0 and doc_id is not null")
    # of equal sets the first document is linked with each other, and one that shows its words stands for all
    groups = real.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.min(F.when(F.size("words") > 0, F.col("doc_id"))).alias("shown"), F.count("*").alias("c"))
    groups = scratch.write(groups.where("c > 1").drop("c"))
    if few_enough(groups):
        groups = F.broadcast(groups)
    copies = real.select("doc_id", "h1", "h2").join(groups, ["h1", "h2"]).select(F.col("first").alias("a"), F.col("doc_id").alias("b")).where("a <> b").distinct()
    keys = real.where(F.size("words") > 0).join(groups.select("h1", "h2", "shown"), ["h1", "h2"], "left").where("shown is null or shown = doc_id")
    keys = key_rows(keys)

    def load(nodes: DataFrame) -> DataFrame:
        return semi_join(docs.select(F.col("doc_id").alias("node"), "text"), nodes, "node")

    def check(pairs: DataFrame, texts: DataFrame) -> DataFrame:
        return check_pairs(pairs, texts, width, similar).distinct()

    def sift(pairs: DataFrame) -> DataFrame:
        return within_hamming(pairs, real.where(F.size("bits") > 0).select(F.col("doc_id").alias("node"), "n", "bits"), similar).distinct()

    def finer(hot: DataFrame) -> DataFrame:
        return finer_keys(hot, hashes, similar)

    known = scratch.write(copies)
    parts = linked_components(keys, load, check, scratch, known, similar=similar, finer=finer, sift=sift)
    scratch.drop(known)
    if few_enough(parts):
        parts = F.broadcast(parts)
    out = made.select("doc_id", F.col("n").alias("n_shingles")).join(parts.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
