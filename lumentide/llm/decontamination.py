"""Benchmark decontamination by q-gram lemma filtering.

Each benchmark item is cut into overlapping windows.  A window of m characters that occurs in
a document with at most e edits shares at least m - q + 1 - q e of its character q-grams with
that place, and all of them lie on diagonals (document position less window position) within
e of each other.  So shared q-grams are counted in overlapping bands of diagonals; bands that
meet the bound are verified by an alignment confined to the band's diagonals.

Windows begin at every STEP-th character, so any copied part of WINDOW + STEP - 1 characters
holds a whole one.  An item shorter than a window is one window; under ``LEAST`` characters it
has to occur without an edit, and under Q characters, where it has no q-gram, it has to be the
document's whole text.

Texts are compared in small letters with each run of white space as one space.  The items are
a stated query set: they go out in blocks of bounded size, one narrow pass over the documents
for each.

Semantics: null and empty texts and items match nothing, nor do items without item_id; of
repeated rows of a (doc_id, item_id) the best match stands, and rows without doc_id count as
one document there (``without_leaks`` decides each row by itself); positions refer to the text
as compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumentide.llm.common import Scratch
from lumentide.llm.shingling import _power_tables

Q = 9
WINDOW = 64
#: Edits in a hundred characters that a window may have.
EDITS = 8
#: Items with fewer characters have to occur exactly.
LEAST = 24
STEP = 8
#: Bands begin at every BAND-th diagonal and are twice as wide.
BAND = 16
#: Characters of items in a block, and of documents handled together.
ITEM_CHARS, TOGETHER = 250_000, 1 << 18
_FILTER_BITS = 22


def plain(text: str | None) -> str:
    return " ".join((text or "").lower().replace("\0", " ").split())


def _grams(text: np.ndarray) -> np.ndarray:
    """Hash of the q-gram at each position of code points."""
    n = len(text) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power, inverse = _power_tables(len(text) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(text) + 1, np.uint64)
        np.cumsum((text.astype(np.uint64) + np.uint64(1)) * power[: len(text)], out=sums[1:])
        return (sums[Q:] - sums[:-Q]) * inverse[:n]


def _slot(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class Index:
    """Windows of a block of items, and where each q-gram stands in them."""

    def __init__(self, items: list[tuple[int, str]]):
        item, length, code, gram, window, place = [], [], [], [], [], []
        self.whole: dict[str, list[int]] = {}
        for item_id, text in items:
            chars = _points(plain(text))
            if len(chars) < Q:
                if len(chars):
                    self.whole.setdefault(plain(text), []).append(item_id)
                continue
            starts = list(range(0, max(1, len(chars) - WINDOW + 1), STEP))
            if starts[-1] + WINDOW < len(chars):
                starts.append(len(chars) - WINDOW)
            for s in starts:
                part = chars[s : s + WINDOW]
                g = _grams(part)
                gram.append(g)
                window.append(np.full(len(g), len(item), np.int32))
                place.append(np.arange(len(g), dtype=np.int32))
                item.append(item_id)
                length.append(len(part))
                code.append(np.pad(part, (0, WINDOW - len(part))))
        self.item, self.length = np.array(item, np.int64), np.array(length, np.int64)
        self.code = np.array(code, np.uint32).reshape(len(item), WINDOW)
        self.edits = np.where(self.length < LEAST, 0, self.length * EDITS // 100)
        self.bound = np.maximum(1, self.length - Q + 1 - Q * self.edits)
        flat = np.concatenate(gram) if gram else np.zeros(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        self.window = np.concatenate(window)[order] if gram else np.zeros(0, np.int32)
        self.place = np.concatenate(place)[order] if gram else np.zeros(0, np.int32)
        self.grams, self.first = np.unique(flat[order], return_index=True)
        self.first = np.r_[self.first, len(flat)]
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[_slot(self.grams)] = True

    def hits(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position, window, position in the window) of every shared q-gram."""
        h = _grams(text)
        if not len(h) or not len(self.grams):
            return (np.zeros(0, np.int64),) * 3
        may = np.flatnonzero(self.filter[_slot(h)])
        at = np.minimum(np.searchsorted(self.grams, h[may]), len(self.grams) - 1)
        sure = self.grams[at] == h[may]
        may, at = may[sure], at[sure]
        times = self.first[at + 1] - self.first[at]
        entry = np.repeat(self.first[at] - np.r_[0, np.cumsum(times)[:-1]], times) + np.arange(times.sum())
        return np.repeat(may, times), self.window[entry].astype(np.int64), self.place[entry].astype(np.int64)

    def align(self, text: np.ndarray, low: np.ndarray, high: np.ndarray, window: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(edits, end position) of the best place of each window on the diagonals base to base + width, inside text[low:high]."""
        slack = int(self.edits.max())
        width = 2 * BAND + 2 * slack
        base = base - slack
        k = np.arange(width)
        cost = np.zeros((len(window), width), np.int32)
        best = np.full(len(window), 1 << 20, np.int32)
        end = np.zeros(len(window), np.int64)
        for i in range(WINDOW):
            at = base[:, None] + k + i
            inside = (at >= low[:, None]) & (at < high[:, None])
            char = text[np.clip(at, 0, len(text) - 1)]
            step = cost + ((char != self.code[window, i][:, None]) | ~inside)
            step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + 1)
            cost = (np.minimum.accumulate(step - k, axis=1) + k).astype(np.int32)
            over = np.flatnonzero(self.length[window] == i + 1)
            if len(over):
                where = cost[over].argmin(axis=1)
                best[over], end[over] = cost[over, where], base[over] + where + i + 1
        return best, end

    def search(self, texts: list[str]) -> list[tuple[int, int, int, int, int]]:
        """(text, window, edits, start, end) of the verified places, the best of each text and window."""
        joined = _points("\0".join(texts))
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        begin = np.r_[0, np.cumsum(lengths + 1)[:-1]]
        pos, window, place = self.hits(joined)
        if not len(pos):
            return []
        owner = np.searchsorted(begin, pos, "right") - 1
        diagonal = pos - place + WINDOW  # not negative
        band = diagonal // BAND
        key = (window << 32) | band
        # each hit counts in the band that begins below it and in the one before
        keys, times = np.unique(np.concatenate((key, key - 1)), return_counts=True)
        enough = times >= self.bound[keys >> 32]
        keys = keys[enough]
        if not len(keys):
            return []
        # the text of a band is that of its hits; bands that reach over two texts are verified in each
        good = np.isin(key, keys), np.isin(key - 1, keys)
        pairs = np.unique(np.concatenate([np.stack((key[good[0]], owner[good[0]])), np.stack((key[good[1]] - 1, owner[good[1]]))], axis=1), axis=1)
        out = []
        for i in range(0, pairs.shape[1], 2000):
            w, doc = pairs[0, i : i + 2000] >> 32, pairs[1, i : i + 2000]
            base = (pairs[0, i : i + 2000] & 0xFFFFFFFF) * BAND - WINDOW
            edits, end = self.align(joined, begin[doc], begin[doc] + lengths[doc], w, base)
            for x in np.flatnonzero(edits <= self.edits[w]).tolist():
                stop = int(end[x] - begin[doc[x]])
                out.append((int(doc[x]), int(w[x]), int(edits[x]), max(0, stop - int(self.length[w[x]])), stop))
        found: dict[tuple[int, int], tuple[int, int, int, int, int]] = {}
        for o in out:
            if o[:2] not in found or o[2:] < found[o[:2]][2:]:
                found[o[:2]] = o
        return sorted(found.values())


def _runs(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Runs of texts with about TOGETHER characters."""
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) < TOGETHER):
            size += len(texts[j])
            j += 1
        yield i, j
        i = j


def _indexes(benchmark: DataFrame) -> Iterator[Index]:
    """The items in blocks of about ITEM_CHARS characters, one at a time on the driver."""
    items = benchmark.where(F.col("item_id").isNotNull() & (F.length("text") > 0)).select(F.col("item_id").cast("long").alias("item_id"), "text")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-total // ITEM_CHARS)
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).orderBy("item_id", "text").collect()
        index = Index([(r["item_id"], r["text"]) for r in part])
        if len(index.item) or index.whole:
            yield index


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, windows (of the item), matched (of them in the document), edits (of those), start, stop.

    docs: doc_id, text; benchmark: item_id, text.  A row for each document and item of which a window is in it.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "leaks")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, item_id long, windows long, matched long, edits long, start long, stop long"
    names = ["doc_id", "item_id", "windows", "matched", "edits", "start", "stop"]
    parts = []
    for index in _indexes(benchmark):
        sent = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            use: Index = sent.value
            of_item = dict(zip(*np.unique(use.item, return_counts=True), strict=True))
            for batch in batches:
                texts = [plain(t) for t in batch.column(1).to_pylist()]
                rows: dict[tuple[int, int], list[int]] = {}
                for i, j in _runs(texts):
                    for doc, window, edits, start, stop in use.search(texts[i:j]):
                        r = rows.setdefault((i + doc, int(use.item[window])), [0, 0, start, stop])
                        r[:] = [r[0] + 1, r[1] + edits, min(r[2], start), max(r[3], stop)]
                for i, text in enumerate(texts):
                    for item in use.whole.get(text, ()):
                        rows[i, item] = [1, 0, 0, len(text)]
                if rows:
                    at = pa.array([k[0] for k in rows], pa.int64())
                    cols = [[k[1] for k in rows], [int(of_item.get(k[1], 1)) for k in rows], *zip(*rows.values(), strict=True)]
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(at), *[pa.array(list(c), pa.int64()) for c in cols]], names=names)

        parts.append(scratch.write(docs.select("doc_id", "text").mapInArrow(run, schema)))
        sent.destroy()
    out = spark.read.schema(schema).parquet(*(x._scratch_path for x in parts)) if parts else spark.createDataFrame([], schema)
    best = F.max_by(F.struct(*names[2:]), F.struct("matched", -F.col("edits"), -F.col("start"), "stop")).alias("b")
    return out.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "b.*")


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """docs less each row whose text holds a window of an item, whatever its doc_id: a pass for each block of items, all but the last written."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "clean")
    body, names, schema = docs.columns.index("text"), docs.columns, docs.schema
    out, before = docs, None
    for index in _indexes(benchmark):
        if before is not None:
            out = scratch.write(out)
            before.destroy()
        before = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], sent=before) -> Iterator[pa.RecordBatch]:
            use: Index = sent.value
            for batch in batches:
                texts = [plain(t) for t in batch.column(body).to_pylist()]
                clean = np.array([t not in use.whole for t in texts], bool)
                for i, j in _runs(texts):
                    for found in use.search(texts[i:j]):
                        clean[i + found[0]] = False
                yield pa.RecordBatch.from_arrays(batch.columns, names=names).filter(pa.array(clean))

        out = out.mapInArrow(run, schema)
    return out
