"""Packing token sequences of documents into fixed windows by the sum-of-squares rule."""

from __future__ import annotations

import json
import os
from collections import defaultdict
from collections.abc import Iterator, Sequence
from functools import cache
from itertools import chain, islice
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import batches, releasing, utf8

SCHEMA = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, "
    "sequence_id long, offset long"
)
_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids", pa.binary()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
    ]
)
#: Distinct words whose ids a task remembers; beyond, it forgets those that it met once.
CACHED_WORDS = 800_000
#: Sequence ids leave room for this many sequences of one task.
PER_TASK = 2**40


def _byte_letters() -> dict[int, str]:
    """The printable character that stands for every byte in byte-level vocabularies:
    itself where it is printable Latin-1, else the next one from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = (b for b in range(256) if b not in own)
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Numbers(dict):
    """Numbers of words in the order in which they are first looked up."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class WordCache:
    """Token ids of texts, encoding every distinct word between ASCII white space once.

    Right for tokenizers that drop white space and never join across it, as the one of
    the query does (its pre-tokenizer splits there and its special tokens hold none).
    Words of plain Latin letters are cut by the tokenizer's own pattern, which this
    class reads from it, and go straight to its model; any other word, and any tokenizer
    built otherwise, takes the whole chain.
    """

    def __init__(self, path: str, limit: int = CACHED_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._model = self._tokenizer.model
        self._cut = self._direct_pattern()
        self._letters = _byte_letters()
        self._limit = limit
        self._clear()

    def _direct_pattern(self):
        """The pre-tokenizer's pattern if the chain is lower-casing, cutting and bytes."""
        # Only these two parts: the whole tokenizer as objects takes its memory several times.
        parts = (self._tokenizer.normalizer, self._tokenizer.pre_tokenizer)
        normalizer, cutter = (json.loads(p.__getstate__()) if p else {} for p in parts)
        steps = [n["type"] for n in normalizer.get("normalizers", [])]
        cutting = cutter.get("pretokenizers", [])
        if steps != ["NFC", "Replace", "Lowercase"] or [c["type"] for c in cutting] != [
            "Split",
            "ByteLevel",
        ]:
            return None
        return regex.compile(cutting[0]["pattern"]["Regex"]).findall

    def _clear(self) -> None:
        self._index = _Numbers()
        self._parts: dict[str, tuple[int, ...]] = {}
        self._starts = np.zeros(1, np.int64)
        self._flat = np.zeros(0, np.uint32)
        self._met = np.zeros(0, np.int64)

    def _forget(self) -> None:
        """Keep what was met again, unless that is most of it."""
        again = np.flatnonzero(self._met > 1)
        words, starts, flat = list(self._index), self._starts, self._flat
        self._clear()
        if 2 * len(again) > self._limit:
            return
        self._index.update(zip([words[i] for i in again.tolist()], range(len(again))))
        lengths = starts[again + 1] - starts[again]
        self._starts = np.concatenate([self._starts, np.cumsum(lengths)])
        self._flat = flat[_runs(starts[again], lengths)]
        self._met = np.zeros(len(again), np.int64)

    def _word(self, word: bytes) -> Sequence[int]:
        """Ids of one word."""
        if self._cut and word.isalpha():
            return self._part(word.lower().decode())
        text = word.decode("utf-8", "replace")
        if not self._cut or not self._plain(text):
            return self._tokenizer.encode(text, add_special_tokens=False).ids
        parts = self._cut(text.lower())
        return [i for part in parts for i in self._part(part)]

    @staticmethod
    def _plain(text: str) -> bool:
        """Latin text whose lower case is the same in every library, not special."""
        if "<|" in text:
            return False
        return text.isascii() or (
            max(text) < "\u0250" and "\u0130" not in text and is_normalized("NFC", text)
        )

    def _part(self, part: str) -> tuple[int, ...]:
        ids = self._parts.get(part)
        if ids is None:
            letters = part
            if not part.isalpha() or not part.isascii():  # ASCII letters stand for themselves
                letters = part.encode().decode("latin-1").translate(self._letters)
            # Tuples of numbers are nothing that the collector of cycles has to look at again.
            ids = self._parts[part] = tuple([t.id for t in self._model.tokenize(letters)])
        return ids

    def _learn(self, words: list[bytes]) -> None:
        """Ids of words that follow the known ones in number."""
        ids = [self._word(w) for w in words]
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        self._starts = np.concatenate([self._starts, np.cumsum(lengths) + self._starts[-1]])
        new = np.fromiter(chain.from_iterable(ids), np.uint32, int(lengths.sum()))
        self._flat = np.concatenate([self._flat, new])

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of every text, in order."""
        if len(self._index) > self._limit:
            self._forget()
        # Lower case ahead of the cache, unless it could make a special token.
        lower = self._cut is not None
        split = [(t.lower() if lower and b"<|" not in t else t).split() for t in texts]
        known, number = len(self._index), self._index.__getitem__
        numbers = [np.fromiter(map(number, words), np.int64, len(words)) for words in split]
        if len(self._index) > known:
            self._learn(list(islice(self._index, known, None)))
        met = np.bincount(np.concatenate([*numbers, self._met[:0]]), minlength=len(self._index))
        met[: len(self._met)] += self._met
        self._met = met
        return [self._ids(n) for n in numbers]

    def _ids(self, numbers: np.ndarray) -> np.ndarray:
        starts = self._starts[numbers]
        return self._flat[_runs(starts, self._starts[numbers + 1] - starts)]


def _runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All places of runs, one run after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


@cache
def word_cache(path: str) -> WordCache:
    """One cache for all tasks of a worker process."""
    return WordCache(path)


class Piece:
    """A run of one document's ids."""

    __slots__ = ("doc_id", "start", "ids", "doc_tokens")

    def __init__(self, doc_id: int | None, start: int, ids: np.ndarray, doc_tokens: int):
        self.doc_id, self.start, self.ids, self.doc_tokens = doc_id, start, ids, doc_tokens

    def cut(self, at: int) -> tuple[Piece, Piece]:
        head = Piece(self.doc_id, self.start, self.ids[:at], self.doc_tokens)
        return head, Piece(self.doc_id, self.start + at, self.ids[at:], self.doc_tokens)


class Packer:
    """Sum-of-squares packing of a stream of pieces into windows of ``capacity`` tokens.

    ``counts[h]`` is the number of open windows filled up to ``h``. A piece goes into
    the level that minimises the sum of the squared counts afterwards, or opens a window
    where that is least; ties take the fullest window. Full windows leave at once.
    """

    def __init__(self, capacity: int, first_sequence: int = 0):
        self.capacity = capacity
        self.counts = np.zeros(capacity + 1, np.int64)
        self._open: dict[int, list[list[Piece]]] = defaultdict(list)
        self._next = first_sequence

    def level_for(self, size: int) -> int:
        """The level whose window takes a piece of ``size``; 0 opens a new one."""
        counts, top = self.counts, self.capacity - size
        # The change of the squares: one window leaves level h, one reaches h + size.
        change = 2 * counts[size : self.capacity + 1] + 1
        change[top] = 0  # a full window is no longer counted
        change[1:] += 1 - 2 * counts[1 : top + 1]
        usable = counts[: top + 1] > 0
        usable[0] = True
        levels = np.flatnonzero(usable)
        costs = change[levels]
        return int(levels[len(costs) - 1 - np.argmin(costs[::-1])])

    def add(self, piece: Piece) -> Iterator[tuple]:
        """Place a piece, cut where it is longer than a window; yields finished rows."""
        while len(piece.ids) >= self.capacity:
            head, piece = piece.cut(self.capacity)
            yield from self._close([head])
        size = len(piece.ids)
        if not size:
            return
        level = self.level_for(size)
        window = self._open[level].pop() if level else []
        self.counts[level] -= level > 0
        window.append(piece)
        if level + size == self.capacity:
            yield from self._close(window)
        else:
            self._open[level + size].append(window)
            self.counts[level + size] += 1

    def flush(self) -> Iterator[tuple]:
        """Close all windows without padding: pieces of the emptiest windows are cut to
        fill the others, and what is left over becomes sequences of powers of two."""
        waiting = [w for level in sorted(self._open) for w in self._open[level]]
        self._open.clear()
        self.counts[:] = 0
        spare: list[Piece] = []
        while waiting:
            window = waiting.pop()
            room = self.capacity - sum(len(p.ids) for p in window)
            while room and (spare or waiting):
                if not spare:
                    spare = waiting.pop(0)
                    continue
                piece = spare.pop()
                if len(piece.ids) > room:
                    piece, rest = piece.cut(room)
                    spare.append(rest)
                window.append(piece)
                room -= len(piece.ids)
            if room:
                spare = window
            else:
                yield from self._close(window)
        left = sum(len(p.ids) for p in spare)
        while left:
            size = 1 << (left.bit_length() - 1)
            window, room = [], size
            while room:
                piece = spare.pop()
                if len(piece.ids) > room:
                    piece, rest = piece.cut(room)
                    spare.append(rest)
                window.append(piece)
                room -= len(piece.ids)
            left -= size
            yield from self._close(window)

    def _close(self, window: list[Piece]) -> Iterator[tuple]:
        offset = 0
        for p in window:
            ids = p.ids.astype("<u4").tobytes()
            yield p.doc_id, p.start, len(p.ids), ids, p.doc_tokens, self._next, offset
            offset += len(p.ids)
        self._next += 1


def pack_documents(
    docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 1
) -> DataFrame:
    """Token ids of ``docs`` (doc_id, text) in sequences of at most ``capacity`` tokens.

    One row per piece: ``doc_id``, ``start`` (ids of its document before it), ``length``,
    ``ids`` (unsigned 32-bit, little-endian), ``doc_tokens``, ``sequence_id`` and its
    ``offset`` there. Every task packs the rows of its own partition with one level
    array, so nothing is shuffled, and closes its last windows without padding by
    cutting pieces. It holds the open windows only.

    A null or empty text is the end token alone; repeated rows are packed each; a null
    ``doc_id`` stays null; other columns are not looked at; no rows give no sequences.
    ``tokenizer_path`` must exist on every executor.
    """

    def pack(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(capacity, TaskContext.get().partitionId() * PER_TASK)
        words = word_cache(tokenizer_path)
        end = np.array([end_id], np.uint32)

        def placed() -> Iterator[tuple]:
            for batch in rows:
                for at in range(0, len(batch), 1024):
                    part = batch.slice(at, 1024)
                    ids = part.column("doc_id").to_pylist()
                    texts = part.column("text").to_pylist()
                    for doc_id, tokens in zip(ids, words.encode(texts), strict=True):
                        tokens = np.concatenate([tokens, end])
                        yield from packer.add(Piece(doc_id, 0, tokens, len(tokens)))
            yield from packer.flush()

        yield from batches(placed(), _ARROW, 1024)

    rows = docs.select(F.col("doc_id").cast("long"), utf8().alias("text"))
    return rows.mapInArrow(releasing(pack), SCHEMA)
