"""Sorted runs of strings of one length: front coding and merging by common prefixes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import zstandard


def common_prefixes(rows: np.ndarray) -> np.ndarray:
    """Length of the prefix that every row shares with the row before; 0 for the first."""
    out = np.zeros(len(rows), np.uint8)
    for a in range(1, len(rows), 1 << 14):
        b = min(len(rows), a + (1 << 14))
        differ = rows[a:b] != rows[a - 1 : b - 1]
        out[a:b] = np.where(differ.any(axis=1), np.argmax(differ, axis=1), rows.shape[1])
    return out


def encode_run(rows: np.ndarray, notes: np.ndarray, table: np.ndarray) -> bytes:
    """A run of sorted rows: prefix lengths, the bytes beyond them, and per row the
    integers ``notes``, the first of which points into the rows of ``table``."""
    shared = common_prefixes(rows)
    beyond = rows[np.arange(rows.shape[1]) >= shared[:, None]]
    head = np.array([*rows.shape, notes.shape[1], *table.shape], "<i8")
    parts = (head, shared, *(planes(note, "<i4") for note in notes.T), table.astype("<i8"), beyond)
    return zstandard.compress(b"".join(np.ascontiguousarray(p).tobytes() for p in parts), 3)


def planes(numbers: np.ndarray, kind: str) -> np.ndarray:
    """The first bytes of all numbers, then the second ones: high bytes that are alike
    stand together, where compression removes them."""
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(numbers.astype(kind)).view(np.uint8).reshape(-1, width).T


def from_planes(data: bytes, n: int, at: int, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    by_place = np.frombuffer(data, np.uint8, n * width, at).reshape(width, n)
    return np.ascontiguousarray(by_place.T).view(kind).ravel()


class Runs:
    """Decoded runs, one after the other.

    ``rows`` are their strings, ``shared`` what each has in common with the one before in
    its run, ``first`` where the runs begin. ``entry`` points into ``table``, ``notes``
    holds the other integers of a row.
    """

    def __init__(self, blobs: list[bytes]):
        shared, notes, tables, beyond, entries = [], [], [], [], 0
        for blob in blobs:
            data = zstandard.decompress(blob)
            n, width, kinds, size, columns = np.frombuffer(data, "<i8", 5).tolist()
            at = 40
            shared.append(np.frombuffer(data, np.uint8, n, at))
            at += n
            own = np.stack([from_planes(data, n, at + 4 * n * i, "<i4") for i in range(kinds)])
            own = own.astype(np.int64)
            own[0] += entries
            notes.append(own)
            at += 4 * n * kinds
            tables.append(np.frombuffer(data, "<i8", size * columns, at).reshape(size, columns))
            entries += size
            beyond.append(np.frombuffer(data, np.uint8, offset=at + 8 * size * columns))
        self.shared = np.concatenate(shared)
        self.entry, *self.notes = np.concatenate(notes, axis=1)
        self.table = np.concatenate(tables)
        self.rows = _decoded(self.shared, np.concatenate(beyond), width)
        self.first = np.cumsum([0] + [len(x) for x in shared[:-1]])


def _decoded(shared: np.ndarray, beyond: np.ndarray, width: int) -> np.ndarray:
    """Rows from the bytes beyond their common prefixes: a byte within a prefix stands
    with the last row before that spells it."""
    size = width - shared.astype(np.int64)
    base = np.cumsum(size) - width  # where column 0 would stand
    number = np.arange(len(shared))
    out = np.empty((width, len(shared)), np.uint8)
    for column in range(width):
        speller = np.maximum.accumulate(np.where(shared <= column, number, 0))
        out[column] = beyond[base[speller] + column]
    return np.ascontiguousarray(out.T)


#: Rows of a block, on average, that the loser tree moves at once.
BLOCK_ROWS = 32


def merged(runs: Runs) -> tuple[np.ndarray, np.ndarray]:
    """The order of all rows, and what each shares with the one before it there.

    Rows of a run that share ``depth`` bytes, as their front coding says, are a block. A
    loser tree merges the blocks by those bytes. Blocks it finds equal meet: their rows
    are sorted by the tree's rank, which stands for the known prefix, and the bytes
    beyond it.
    """
    n, width = runs.rows.shape
    blocks = np.cumsum(np.bincount(runs.shared, minlength=width))  # at depth 1, 2 ...
    fine = np.flatnonzero(blocks <= max(len(runs.first), n // BLOCK_ROWS))
    depth = min(width - 1, int(fine[-1]) + 1) if len(fine) else 1
    heads = np.flatnonzero(runs.shared < depth)
    cuts = np.searchsorted(heads, runs.first)
    spelled = np.ascontiguousarray(runs.rows[heads, :depth]).tobytes()
    strings = [spelled[i : i + depth] for i in range(0, len(spelled), depth)]
    shared = runs.shared[heads].tolist()
    rank = np.empty(len(heads), np.int64)
    apart: list[int] = []
    for same, head in merge_heads(strings, shared, [*cuts.tolist(), len(heads)]):
        if same < depth:
            apart.append(same)
        rank[head] = len(apart) - 1
    rank = np.repeat(rank, np.diff(np.append(heads, n)))
    keys = np.empty((n, 8 + width - depth), np.uint8)
    keys[:, :8] = rank.astype(">i8").view(np.uint8).reshape(n, 8)
    keys[:, 8:] = runs.rows[:, depth:]
    order = np.argsort(keys.view(f"S{keys.shape[1]}").ravel(), kind="stable")
    rank = rank[order]
    out = common_prefixes(keys[order][:, 8:]).astype(np.int64) + depth
    new = np.flatnonzero(np.diff(rank, prepend=-1))
    out[new] = apart
    return order, out


def merge_heads(
    strings: list[bytes], prefixes: list[int], cuts: list[int]
) -> Iterator[tuple[int, int]]:
    """Strings of several sorted lists, which lie between the cuts, in order: (length
    shared with the last string, place).

    A loser tree whose nodes remember how much the loser shares with the winner that
    passed. Of two strings, the one that shares more with the last one put out is
    smaller; only strings that share equally much are compared, and only beyond that
    length, so no known prefix is read twice.
    """
    lists = len(cuts) - 1
    width = 1
    while width < lists:
        width *= 2
    at = cuts[:-1]
    ends = cuts[1:]
    shared = [0 if a < b else -1 for a, b in zip(at, ends)] + [-1] * (width - lists)
    rows = [strings[a] if a < b else b"" for a, b in zip(at, ends)] + [b""] * (width - lists)
    losers = [0] * width

    def play(a: int, b: int) -> tuple[int, int]:
        ha, hb = shared[a], shared[b]
        if ha > hb:
            return a, b
        if hb > ha:
            return b, a
        if ha < 0:
            return a, b
        ra, rb = rows[a], rows[b]
        if ra == rb:
            shared[b] = len(rb)
            return a, b
        x = int.from_bytes(ra[ha:]) ^ int.from_bytes(rb[ha:])
        same = len(ra) - (x.bit_length() + 7) // 8
        if ra[same] < rb[same]:
            shared[b] = same
            return a, b
        shared[a] = same
        return b, a

    level = list(range(width))
    node = width
    while len(level) > 1:
        node //= 2
        pairs = [play(level[i], level[i + 1]) for i in range(0, len(level), 2)]
        losers[node : node + len(pairs)] = [loser for _, loser in pairs]
        level = [winner for winner, _ in pairs]
    winner = level[0]
    while shared[winner] >= 0:
        place = at[winner]
        yield shared[winner], place
        at[winner] = place = place + 1
        if place < ends[winner]:
            shared[winner], rows[winner] = prefixes[place], strings[place]
        else:
            shared[winner] = -1
        node = (width + winner) >> 1
        while node:
            other = losers[node]
            ha, hb = shared[winner], shared[other]
            if hb > ha:
                losers[node], winner = winner, other
            elif ha == hb:
                winner, losers[node] = play(winner, other)
            node >>= 1
