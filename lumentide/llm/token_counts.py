"""Token counts: rank-synchronous array merging over batched pre-tokens.

A byte-level BPE encoder repeats, for each pre-token, "merge the pair of lowest
rank".  Here many distinct pre-tokens are held as one ragged numpy array of symbol
ids and all of them take a step together: each sequence finds its lowest-rank pair,
merges every non-overlapping occurrence of it from the left, and the survivors are
counted once no sequence has a known pair.  Each task keeps a bounded memory of
pre-tokens that it has counted, since words recur.

Semantics: null text counts as empty (0 tokens); the file's added special strings
inside a text are one token each, as the library treats them by default; no begin or
end tokens, truncation or padding.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: the pre-token pattern of the byte-level tokenizer files.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: A task forgets older counted pre-tokens beyond this many.
REMEMBERED = 1_000_000
#: Characters whose pre-tokens are merged together.
TOGETHER = 1 << 22
#: The rank of a pair that no merge has.
NONE = np.int64(1) << 40
#: Pre-tokens longer than this are not remembered, only counted.
LONGEST_KEY = 256
#: Characters of one text given to the pattern at a time, cut only where no pre-token can span.
PIECE = 1 << 20


def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: Latin-1 where it prints, else from U+0100 on."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in prints else chr(next(rest)) for b in range(256)]


class MergeTable:
    """Vocabulary and merge ranks of a byte-level BPE file, as sorted arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        self.byte_ids = np.array([vocab[s] for s in byte_symbols()], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        keys = left << 32 | right
        self._index(keys, made)
        self.special = sorted((t["content"] for t in spec.get("added_tokens", [])), key=len, reverse=True)

    def _index(self, keys: np.ndarray, made: np.ndarray) -> None:
        """An open hash table from symbol pair to rank and merged symbol; of equal pairs the first rank holds."""
        bits = max(10, int(8 * len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.slots = np.full((1 << bits) + 64, -1, np.int64)
        self.rank_at = np.full(len(self.slots), NONE, np.int64)
        self.made_at = np.zeros(len(self.slots), np.int64)
        left = np.arange(len(keys))
        at = self._home(keys)
        while len(left):
            taken = self.slots[at]
            again = taken == keys[left]
            free = taken == -1
            # of those that want a free slot the lowest rank gets it
            first = np.unique(np.where(free, at, -1 - np.arange(len(at))), return_index=True)[1]
            first = first[free[first]]
            self.slots[at[first]], self.rank_at[at[first]], self.made_at[at[first]] = keys[left[first]], left[first], made[left[first]]
            stay = ~again
            stay[first] = False
            at = np.where(self.slots[at] == keys[left], at, at + 1)[stay]
            left = left[stay]

    def _home(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).view(np.int64)

    def slot(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each pair; a slot of rank NONE if the pair is unknown."""
        at = self._home(keys)
        off = np.flatnonzero((self.slots[at] != keys) & (self.slots[at] != -1))
        while len(off):
            at[off] += 1
            now = self.slots[at[off]]
            off = off[(now != keys[off]) & (now != -1)]
        return at

    def counts(self, tokens: list[bytes]) -> np.ndarray:
        """Number of symbols that each pre-token ends as."""
        data = np.frombuffer(b"".join(tokens), np.uint8)
        lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
        symbols, owner = self.byte_ids[data], np.repeat(np.arange(len(tokens), dtype=np.int32), lengths)
        done = np.zeros(len(tokens), np.int64)
        # rank and merged symbol of each symbol with its right neighbour; NONE at the end of a sequence
        rank, merged = np.full(len(symbols), NONE), np.zeros(len(symbols), np.int64)
        stale = np.arange(len(symbols))
        while len(symbols):
            pair = stale[stale + 1 < len(symbols)]
            pair = pair[owner[pair] == owner[pair + 1]]
            rank[stale] = NONE
            at = self.slot(symbols[pair] << 32 | symbols[pair + 1])
            rank[pair], merged[pair] = self.rank_at[at], self.made_at[at]
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            sizes = np.diff(np.r_[starts, len(owner)])
            lowest = np.minimum.reduceat(rank, starts)
            ended = lowest == NONE
            done[owner[starts[ended]]] = sizes[ended]
            where = np.flatnonzero((rank == np.repeat(lowest, sizes)) & (rank != NONE))
            if len(where):
                # in a run of overlapping occurrences (aaa) every other one merges, from the left
                run_start = np.r_[True, where[1:] != where[:-1] + 1]
                begin = np.maximum.accumulate(np.where(run_start, np.arange(len(where)), 0))
                where = where[(np.arange(len(where)) - begin) % 2 == 0]
                symbols[where] = merged[where]
            keep = np.repeat(~ended, sizes)
            keep[where + 1] = False
            changed = np.zeros(len(symbols), bool)
            changed[where] = True
            changed[np.maximum(where - 1, 0)] = True
            # a symbol whose right neighbour went has that neighbour's neighbour now, and is itself the merged one
            before = where - 2
            changed[before[before >= 0]] = True
            symbols, owner, rank, merged, changed = symbols[keep], owner[keep], rank[keep], merged[keep], changed[keep]
            stale = np.flatnonzero(changed)
        return done


def pieces(text: str, most: int = PIECE) -> Iterator[str]:
    """The text in parts cut before a space that follows and precedes a letter: no pre-token spans such a cut."""
    start = 0
    while len(text) - start > most:
        cut = start + most
        while True:
            cut = text.find(" ", cut)
            if cut < 0 or cut + 1 >= len(text):
                cut = len(text)
                break
            if text[cut - 1].isalpha() and text[cut + 1].isalpha():
                break
            cut += 1
        yield text[start:cut]
        start = cut
    if start < len(text):
        yield text[start:]


class Counter:
    """Counts the tokens of texts, remembering pre-tokens."""

    def __init__(self, merges: MergeTable, remembered: int = REMEMBERED):
        self.merges, self.remembered = merges, remembered
        self.split = regex.compile(PATTERN).findall
        self.known: dict[str, int] = {}
        self.cut = regex.compile("|".join(map(regex.escape, merges.special))) if merges.special else None

    def _learn(self, words: set[str]) -> dict[str, int]:
        new = list(words)
        got: dict[str, int] = {}
        for i in range(0, len(new), 50_000):
            part = new[i : i + 50_000]
            got.update(zip(part, self.merges.counts([w.encode("utf-8", "surrogatepass") for w in part]).tolist(), strict=True))
        return got

    def many(self, parts: list[str]) -> list[int]:
        """Tokens of each part; all their unknown pre-tokens are merged together."""
        words = [self.split(p) for p in parts]
        distinct = set().union(*words)
        got = self._learn(distinct - self.known.keys())
        if len(self.known) + len(got) > self.remembered:
            self.known = {w: n for w, n in self.known.items() if w in distinct}
        known = self.known
        known.update(got)
        out = [sum(map(known.__getitem__, w)) for w in words]
        for w in got:
            if len(w) > LONGEST_KEY:
                del known[w]
        if len(known) > self.remembered:
            known.clear()
        return out

    def count(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text."""
        totals = [0] * len(texts)
        parts: list[str] = []
        owners: list[int] = []
        held = 0

        def settle() -> None:
            for i, n in zip(owners, self.many(parts), strict=True):
                totals[i] += n
            parts.clear()
            owners.clear()

        for i, text in enumerate(texts):
            if not text:
                continue
            plain = [text]
            if self.cut is not None and any(s in text for s in self.merges.special):
                plain = self.cut.split(text)
                totals[i] += len(plain) - 1
            for piece in plain:
                for part in pieces(piece):
                    parts.append(part)
                    owners.append(i)
                    held += len(part)
                    if held >= TOGETHER:
                        settle()
                        held = 0
        settle()
        return totals


_tables: dict[str, MergeTable] = {}


def count_tokens(docs: DataFrame, tokenizer: str, text: str = "text", limit: int = 512, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns with n_bytes, n_tokens and over_limit of every whole text.

    tokenizer: path of a byte-level BPE .json file that every executor can open (it ships with
    an installed package).  One narrow pass: no shuffle.  An empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _tables:
            _tables[tokenizer] = MergeTable(tokenizer)
        counter = Counter(_tables[tokenizer])
        for batch in batches:
            n = counter.count(batch.column(len(keep)).to_pylist())
            kept = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*kept, batch.column(len(keep) + 1), pa.array(n, pa.int64())], names=names)

    names = [*[f"k{i}" for i in range(len(keep))], "n_bytes", "n_tokens"]
    body = F.coalesce(F.col(text), F.lit(""))
    cols: list[Column] = [F.col(c).alias(f"k{i}") for i, c in enumerate(keep)]
    source = docs.select(*cols, body.alias("body"), F.octet_length(body).cast("long").alias("n_bytes"))
    schema = ", ".join([*(f"k{i} {source.schema[f'k{i}'].dataType.simpleString()}" for i in range(len(keep))), "n_bytes long", "n_tokens long"])
    out = source.mapInArrow(run, schema)
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
