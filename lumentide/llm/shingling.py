"""Word shingles of many texts at once, as 64-bit hashes in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from lumentide.llm.common import groups_of, mix64

#: Bytes hashed together; a longer text is cut at white space.
PIECE = 1 << 19
_P = 0x9E3779B97F4A7C15 | 1
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32
_LOWER += 1
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
_SALTS = mix64(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2^64."""
    if len(_powers[0]) < n:
        inverse = pow(_P, -1, 1 << 64)
        size = max(n, PIECE * 2)
        with np.errstate(over="ignore"):
            for i, base in enumerate((_P, inverse)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                _powers[i] = np.cumprod(steps)
    return _powers[0], _powers[1]


def _hash_words(data: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, start of each word) of bytes; ``first`` marks where texts begin."""
    power, inverse = _power_tables(len(data) + 1)
    word = ~_SPACE[data]
    starts = word.copy()
    starts[1:] &= ~word[:-1] | first[1:]
    ends = word.copy()
    ends[:-1] &= ~word[1:] | first[1:]
    s, e = np.flatnonzero(starts), np.flatnonzero(ends)
    with np.errstate(over="ignore"):
        sums = np.cumsum(_LOWER[data] * power[: len(data)])
        raw = (sums[e] - np.where(s > 0, sums[s - 1], np.uint64(0))) * inverse[s]
        return mix64(raw + (e - s).astype(np.uint64) * _SALTS[63]), s


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words (lower-cased A-Z, parted by white space) of texts, and their offsets by text."""
    if len(offsets) == 2 and offsets[1] - offsets[0] > 4 * PIECE:
        parts, at, end = [], int(offsets[0]), int(offsets[1])
        while at < end:
            stop = min(end, at + PIECE)
            while stop < end and not _SPACE[data[stop]]:
                ahead = np.flatnonzero(_SPACE[data[stop : stop + PIECE]])
                stop = stop + int(ahead[0]) if len(ahead) else min(end, stop + PIECE)
            piece = data[at:stop]
            parts.append(_hash_words(piece, np.zeros(len(piece), bool))[0])
            at = stop
        words = np.concatenate(parts)
        return words, np.array([0, len(words)])
    piece = data[offsets[0] : offsets[-1]]
    bounds = offsets - offsets[0]
    first = np.zeros(len(piece) + 1, bool)
    first[bounds[:-1]] = True
    words, starts = _hash_words(piece, first[:-1]) if len(piece) else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    return words, np.searchsorted(starts, bounds)


def shingle_hashes(data: np.ndarray, offsets: np.ndarray, width: int = 5) -> Iterator[np.ndarray]:
    """For each text the hashes of its shingles of ``width`` words, in order; of fewer words, the whole sequence as one."""
    for i, j in groups_of(offsets, PIECE):
        words, bounds = word_hashes(data, offsets[i : j + 1])
        with np.errstate(over="ignore"):
            if len(words) >= width:
                total = words[: len(words) - width + 1] * _SALTS[0]
                for k in range(1, width):
                    total = total + words[k : len(words) - width + 1 + k] * _SALTS[k]
                total = mix64(total)
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                if b - a >= width:
                    yield total[a : b - width + 1]
                elif b > a:
                    few = (words[a:b] * _SALTS[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a) * _SALTS[40]
                    yield mix64(np.array([few], np.uint64))
                else:
                    yield words[:0]
