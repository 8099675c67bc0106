"""Fuzzy line dedup by MinHash.

Lines are compared in small letters with each run of white space as one space.  A line's set is
its character shingles; its signature holds the least value of each of many hash functions over
the set, and lines that agree in a band of the signature are candidates.  The bands are many and
narrow, so that a pair at the threshold is a candidate with odds of 99 %.  Candidates are
verified by the exact Jaccard similarity of their sets; verified links are joined by distributed
union-find, and of each component the first line (by doc_id, then line number) stays.

A band that many lines share is not expanded into pairs: its lines are checked against one of
them, and those of bands that stay in several components meet by their rarest shingles
(``ngram_join.finer_keys``), which miss no link among them.

Equal lines meet by the hash of the line (64 bits), so a task signs each line once and repeated
lines are rows of a count, not pairs.

A line shorter than a shingle is one shingle, the whole line, which no longer line holds.

Semantics: every line that is not empty takes part, however short, but lines with fewer than
``least`` characters where a caller asks for that, and those of rows without doc_id, which stay;
null and empty texts have no lines.  Rows that repeat give repeated rows; a line goes only if
the text of its row has it at its place, so rows of one doc_id lose no text of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumentide.llm.common import Scratch, common, distinct, few_enough, free_name, long_list, mix64, semi_join
from lumentide.llm.linking import linked_components
from lumentide.llm.ngram_join import finer_keys
from lumentide.llm.shingling import _power_tables

SHINGLE = 8
#: Lines are alike if 100 * intersection >= SIMILAR * union.
SIMILAR = 75
#: What ``least`` is where a caller names none: lines of any length take part.
LEAST = 1
#: Fills a line up to SHINGLE characters: a lone surrogate, which no text of a table holds.
FILL = "\udfff"
#: At a similarity of 0.75 a band of four agrees with odds 0.32, one of twelve with odds 0.99.
BANDS, ROWS = 12, 4
#: Characters hashed together, and lines that a task remembers to have signed.
TOGETHER, REMEMBERED = 1 << 18, 300_000
#: Mask of the digits of a line's hash that the sieve tells apart: a bitmap of 4 MB.
SIEVE = (1 << 25) - 1

_ODD = (mix64(np.arange(1001, BANDS * ROWS + 1001, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def normal(line: str) -> str:
    line = line.lower()
    # of white space only the space is printable, so these are lines that split and join would not change
    if line.isprintable() and "  " not in line and line[:1] != " " and line[-1:] != " ":
        return line
    return " ".join(line.split())


def line_hash(line: str) -> int:
    return xxhash.xxh3_64_intdigest(line.encode("utf-8", "surrogatepass")) - (1 << 63)


def _shingles(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of lines that are not empty, and where each line's begin."""
    lines = [x if len(x) >= SHINGLE else x.ljust(SHINGLE, FILL) for x in lines]
    text = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter(map(len, lines), np.int64, len(lines))
    power, inverse = _power_tables(len(text) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(text) + 1, np.uint64)
        np.cumsum((text.astype(np.uint64) + np.uint64(1)) * power[: len(text)], out=sums[1:])
        h = (sums[SHINGLE:] - sums[:-SHINGLE]) * inverse[: len(text) - SHINGLE + 1]
    whole = np.ones(len(h), bool)
    ends = np.cumsum(lengths)[:-1]
    for k in range(1, SHINGLE):
        whole[ends - k] = False
    return mix64(h[whole]), np.r_[0, np.cumsum(lengths - SHINGLE + 1)]


def shingle_sets(lines: list[str]) -> list[np.ndarray]:
    """The sorted distinct shingles of each line."""
    out: list[np.ndarray] = []
    i = 0
    while i < len(lines):
        j, size = i, 0
        while j < len(lines) and (j == i or size + len(lines[j]) <= TOGETHER):
            size += len(lines[j])
            j += 1
        h, starts = _shingles(lines[i:j])
        out += [distinct(h[a:b]) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
        i = j
    return out


def signatures(lines: list[str]) -> np.ndarray:
    """Band keys, a row of BANDS for each line."""
    h, starts = _shingles(lines)
    h = (h >> np.uint64(32)).astype(np.uint32)
    low = np.empty((BANDS * ROWS, len(lines)), np.uint64)
    held = np.empty_like(h)
    for k in range(0, BANDS * ROWS, 2):  # the least value of a hash function, and of the same one counted down
        np.multiply(h, _ODD[k], out=held)
        low[k] = np.minimum.reduceat(held, starts[:-1])
        low[k + 1] = np.maximum.reduceat(held, starts[:-1])
    out = np.empty((len(lines), BANDS), np.uint64)
    for b in range(BANDS):
        key = np.full(len(lines), b, np.uint64)
        for k in range(b * ROWS, (b + 1) * ROWS):
            key = mix64(key ^ low[k])
        out[:, b] = key
    return out


def lines_of(docs: DataFrame, signed: bool, least: int = LEAST, sieve: np.ndarray | None = None) -> DataFrame:
    """doc_id, line_no, h, and the line's bands (none if the task has signed it) or, not signed, its text; of the lines that pass the sieve."""
    sent = docs.sparkSession.sparkContext.broadcast(sieve)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[int] = set()
        sieve = sent.value
        for batch in batches:
            ids = batch.column(0).to_pylist()
            doc, number, hashes, texts, new, size = [], [], [], [], [], 0

            def made():
                last = None
                if signed:
                    fresh = [texts[i] for i in new]
                    keys = signatures(fresh) if fresh else np.zeros((0, BANDS), np.uint64)
                    lengths = np.zeros(len(texts), np.int64)
                    lengths[new] = BANDS
                    last = long_list(keys.ravel().view(np.int64), lengths)
                else:
                    last = pa.array(texts, pa.string())
                out = pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(number, pa.int32()), pa.array(hashes, pa.int64()), last], names=["doc_id", "line_no", "h", "last"])
                for held in (doc, number, hashes, texts, new):
                    held.clear()
                return out

            for i, text in zip(ids, batch.column(1).to_pylist(), strict=True):
                if not text:
                    continue
                for n, raw in enumerate(text.split("\n")):
                    line = normal(raw)
                    if len(line) < max(least, 1):
                        continue
                    h = line_hash(line)
                    if sieve is not None and not sieve[(h & SIEVE) >> 3] >> (h & 7) & 1:
                        continue
                    if h not in known:
                        if len(known) >= REMEMBERED:
                            known.clear()
                        known.add(h)
                        new.append(len(texts))
                        size += max(len(line), SHINGLE)
                    elif not signed:
                        continue
                    doc.append(i)
                    number.append(n)
                    hashes.append(h)
                    texts.append(line)
                    if size >= TOGETHER:
                        yield made()
                        size = 0
            if texts:
                yield made()

    last = "bands array<long>" if signed else "line string"
    return docs.where("doc_id is not null").select(F.col("doc_id").cast("long"), "text").mapInArrow(run, f"doc_id long, line_no int, h long, {last}")


def sieve_of(nodes: DataFrame) -> np.ndarray:
    """A bitmap of fixed size with a bit for the last digits of each node."""
    bit = F.col("node").bitwiseAND(F.lit(SIEVE))
    maps = nodes.groupBy(F.shiftright(bit, 15).alias("part")).agg(F.bitmap_construct_agg(bit.bitwiseAND(F.lit(32767))).alias("bits")).toArrow()
    out = np.zeros((SIEVE + 1 >> 15, 4096), np.uint8)
    for part, bits in zip(maps["part"].to_pylist(), maps["bits"].to_pylist(), strict=True):
        out[part] = np.frombuffer(bits, np.uint8)
    return out.ravel()


def lines_of_nodes(docs: DataFrame, nodes: DataFrame, least: int = LEAST) -> DataFrame:
    """node, line: the lines whose hash is a node.  A task lets by what the sieve does not hold; the join is exact."""
    lines = lines_of(docs, False, least, sieve_of(nodes)).select(F.col("h").alias("node"), "line")
    return semi_join(lines, nodes, "node").groupBy("node").agg(F.first("line").alias("line"))


def check_lines(pairs: DataFrame, lines: DataFrame) -> DataFrame:
    """The pairs (a, b) of nodes whose lines (node, line) are alike."""
    both = pairs.join(lines.select(F.col("node").alias("a"), F.col("line").alias("line_a")), "a").join(lines.select(F.col("node").alias("b"), F.col("line").alias("line_b")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = []
            for column in (batch.column(2), batch.column(3)):
                encoded = column.dictionary_encode()
                sides.append((encoded.indices.to_numpy(), shingle_sets(encoded.dictionary.to_pylist())))
            keep = np.zeros(len(batch.column(0)), bool)
            for i, (x, y) in enumerate(zip(sides[0][0].tolist(), sides[1][0].tolist(), strict=True)):
                p, q = sides[0][1][x], sides[1][1][y]
                if min(len(p), len(q)) * 100 >= SIMILAR * max(len(p), len(q)):
                    both = common(p, q)
                    keep[i] = 100 * both >= SIMILAR * (len(p) + len(q) - both)
            mask = pa.array(keep)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])

    return both.select("a", "b", "line_a", "line_b").mapInArrow(run, "a long, b long")


def fuzzy_lines(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, line_no (from 0), h (the line's hash), class_doc, class_line (the first line of its component), kept: of every line that takes part.

    docs: doc_id, text; least: the fewest characters of a line that takes part.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    made = scratch.write(lines_of(docs, True, least))
    keys = made.select(F.explode("bands").alias("key"), F.col("h").alias("node"))

    def finer(hot: DataFrame) -> DataFrame:
        return finer_keys(hot.withColumnRenamed("line", "text"), lambda lines: shingle_sets(lines.to_pylist()), SIMILAR)

    parts = linked_components(keys, lambda nodes: lines_of_nodes(docs, nodes, least), check_lines, scratch, similar=SIMILAR, finer=finer)
    if few_enough(parts):
        parts = F.broadcast(parts)
    lines = made.select("doc_id", "line_no", "h").join(parts.withColumnRenamed("node", "h"), "h", "left")
    placed = scratch.write(lines.select("doc_id", "line_no", "h", F.coalesce("component", "h").alias("component")))
    scratch.drop(made)
    # (doc_id, line_no) in one number, a long where all of them fit, so that the first line of a component is found by hash aggregation
    low, high, most = placed.agg(F.min("doc_id"), F.max("doc_id"), F.max("line_no")).first()
    of = (most or 0) + 1
    kind = "long" if (max(abs(low or 0), abs(high or 0)) + 2) * of < 1 << 62 else "decimal(38,0)"
    place = F.expr(f"cast(cast(doc_id as {'long' if kind == 'long' else 'decimal(20,0)'}) * {of} + line_no as {kind})")
    firsts = placed.groupBy("component").agg(F.min(place).alias("place"), F.count("*").alias("n")).where("n > 1")
    firsts = firsts.select("component", "place", F.expr(f"pmod(place, {of})").alias("line"))
    firsts = scratch.write(firsts.select("component", F.expr(f"(place - line) div {of}").cast("long").alias("class_doc"), F.col("line").cast("int").alias("class_line")))
    if few_enough(firsts):
        firsts = F.broadcast(firsts)
    kept = (F.col("doc_id") == F.col("class_doc")) & (F.col("line_no") == F.col("class_line"))
    out = placed.join(firsts, "component", "left").withColumn("class_doc", F.coalesce("class_doc", "doc_id")).withColumn("class_line", F.coalesce("class_line", "line_no"))
    return out.select("doc_id", "line_no", "h", "class_doc", "class_line", kept.alias("kept"))


def without_lines(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """docs less the lines that are not kept; a document of which no line with text is left goes, one that lost none stays as it is.

    lines: rows of ``fuzzy_lines``.  A line goes if it is at its place in the row's text; so of rows that repeat a doc_id each loses its own lines.
    """
    lost = free_name(docs, "lost")
    gone = lines.where("not kept")
    few = few_enough(gone)
    gone = gone.groupBy("doc_id").agg(F.collect_set(F.struct("line_no", "h")).alias(lost))
    names = docs.columns
    both = docs.join(F.broadcast(gone) if few else gone, "doc_id", "left").select(*names, lost)
    body, at = names.index("text"), len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, stay = batch.column(body).to_pylist(), []
            for i, drop in enumerate(batch.column(at).to_pylist()):
                if drop and texts[i]:
                    drop = {(x["line_no"], x["h"]) for x in drop}
                    at_risk = {n for n, _ in drop}
                    raw = texts[i].split("\n")
                    left = [x for n, x in enumerate(raw) if n not in at_risk or (n, line_hash(normal(x))) not in drop]
                    if len(left) < len(raw):
                        texts[i] = "\n".join(left)
                        stay.append(bool(texts[i].strip()))
                        continue
                stay.append(True)
            columns = [batch.column(k) for k in range(at)]
            columns[body] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array(stay, pa.bool_()))

    return both.mapInArrow(run, docs.schema)
