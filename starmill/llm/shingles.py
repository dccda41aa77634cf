"""Hashed word shingles of many texts at once."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from starmill.llm.common import mix64

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_BASE = np.uint64(0x9FB21C651E98DF25)
#: Bytes worked on at once.
CHUNK = 1 << 21


def text_bytes(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column end to end, and where each value starts."""
    column = batch.column(name)
    _, offsets, values = column.buffers()
    starts = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    return data, starts.astype(np.int64)


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of ``data`` and where they start."""
    letters = _LOWER[data]
    inside = ~_SPACE[letters]
    edges = np.diff(inside.astype(np.int8), prepend=0, append=0)
    first, last = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    if not len(first):
        return np.zeros(0, np.uint64), first
    # Sum of mixed (letter, place in its word) pairs: equal words have equal sums.
    at = np.flatnonzero(inside)
    length = last - first
    place = np.arange(len(at)) - np.repeat(np.cumsum(length) - length, length)
    with np.errstate(over="ignore"):
        coded = mix64(letters[at].astype(np.uint64) + (place.astype(np.uint64) << np.uint64(8)), 1)
        sums = np.add.reduceat(coded * _BASE, np.cumsum(length) - length)
        return mix64(sums + length.astype(np.uint64), 2), first


def shingle_sets(data: np.ndarray, starts: np.ndarray, words: int = 3) -> list[np.ndarray]:
    """The distinct shingles of every text as sorted 64-bit hashes.

    Text i is ``data[starts[i]:starts[i + 1]]``. Words are what ASCII white space
    separates, A-Z in lower case; a text of fewer words is one shingle, one without
    words has none.
    """
    sets: list[np.ndarray] = []
    n, i = len(starts) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + CHUNK, side="right")) - 1)
        base = starts[i]
        # A space after each text keeps words apart; texts may touch in the buffer.
        hashes, at = _apart(data, starts[i : j + 1])
        cuts = np.searchsorted(at, starts[i : j + 1] - base + np.arange(j - i + 1))
        with np.errstate(over="ignore"):
            grams = hashes.copy()
            for k in range(1, words):
                grams = mix64(grams[:-1] + hashes[k:] * np.uint64(2 * k + 1), 3) if len(grams) > 1 else grams[:0]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if b - a >= words:
                sets.append(np.unique(grams[a : b - words + 1]))
            elif b > a:
                sets.append(_whole(hashes[a:b]))
            else:
                sets.append(np.zeros(0, np.uint64))
        i = j
    return sets


def _apart(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.diff(starts)
    out = np.full(int(sizes.sum()) + len(sizes), 32, np.uint8)
    place = np.arange(int(sizes.sum())) + np.repeat(np.arange(len(sizes)), sizes)
    out[place] = data[starts[0] : starts[-1]]
    return _word_hashes(out)


def _whole(hashes: np.ndarray) -> np.ndarray:
    """A text shorter than a shingle, apart from any real shingle."""
    with np.errstate(over="ignore"):
        one = np.uint64(len(hashes))
        for h in hashes:
            one = mix64(np.array([one * np.uint64(5) + h]), 4)[0]
    return np.array([one], np.uint64)


def set_digest(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that are equal for equal sets."""
    with np.errstate(over="ignore"):
        return tuple(int(mix64(shingles, seed).sum(dtype=np.uint64).astype(np.int64)) for seed in (11, 12))


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, for sorted distinct hashes."""
    if not len(a) or not len(b):
        return False
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= percent * (len(a) + len(b) - shared)
