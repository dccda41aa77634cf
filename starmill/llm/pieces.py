"""A unigram vocabulary of subword pieces and its lattices over words."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

from starmill.llm.common import mix64

#: Added to a piece's rank before it is read as a frequency rank (Zipf-Mandelbrot).
RANK_OFFSET = 2.7


_FACTOR = np.uint64(0x9E3779B97F4A7C15)


class Trie:
    """Beginnings of pieces by a hash of their bytes, to be looked up many at once."""

    def __init__(self, pieces: list[bytes]):
        known = {p[:n]: -1 for p in pieces for n in range(1, len(p))}
        known.update((p, i) for i, p in enumerate(pieces))
        keys = np.zeros(len(known), np.uint64)
        for i, beginning in enumerate(known):
            key = 0
            for byte in beginning:
                key = (key * int(_FACTOR) + byte + 1) % 2**64
            keys[i] = key
        numbers = np.fromiter(known.values(), np.int32, len(known))
        self.longest = max(map(len, pieces), default=0)
        # Two tables; what collides in the first goes to the second, the rest to a list.
        self._keys = np.zeros((2, 1 << 19), np.uint64)
        self._numbers = np.full((2, 1 << 19), -2, np.int32)
        rest = np.arange(len(keys))
        for table in range(2):
            slots, first = np.unique(self._slot(keys[rest], table), return_index=True)
            self._keys[table, slots] = keys[rest[first]]
            self._numbers[table, slots] = numbers[rest[first]]
            rest = np.delete(rest, first)
        rest = rest[np.argsort(keys[rest])]
        self._rest, self._rest_numbers = keys[rest], numbers[rest]

    @staticmethod
    def _slot(keys: np.ndarray, table: int) -> np.ndarray:
        return (mix64(keys, 71 + table) >> np.uint64(45)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The piece of every key, -1 where it only begins pieces, -2 where it does not."""
        slot = self._slot(keys, 0)
        out = self._numbers[0, slot]
        # Where the slot is free, no table has the key.
        at = np.flatnonzero((self._keys[0, slot] != keys) & (out > -2))
        out[at] = -2
        slot = self._slot(keys[at], 1)
        hit = self._keys[1, slot] == keys[at]
        number = self._numbers[1, slot]
        out[at[hit]] = number[hit]
        at = at[~hit & (number > -2)]
        if len(self._rest):
            place = np.minimum(np.searchsorted(self._rest, keys[at]), len(self._rest) - 1)
            hit = self._rest[place] == keys[at]
            out[at[hit]] = self._rest_numbers[place[hit]]
        return out


@dataclass
class Vocabulary:
    """Pieces as bytes, a leading space included, their ids and log probabilities."""

    pieces: list[bytes]
    ids: np.ndarray
    log_probs: np.ndarray
    trie: Trie = field(repr=False)

    @staticmethod
    def of(pieces: list[bytes], ids: list[int], log_probs: np.ndarray) -> Vocabulary:
        return Vocabulary(pieces, np.array(ids, np.int64), log_probs, Trie(pieces))


def read_vocabulary(path: str) -> Vocabulary:
    """The pieces of a sentencepiece model file with scores as log probabilities.

    A unigram model's scores are log probabilities. A model whose scores only rank its
    pieces, as those of merges do, is read as ranks by falling score, and a rank r has a
    probability in proportion to 1 / (r + 2.7). Bytes of the fallback are pieces; where
    a piece spells the same byte, it stands for both. Control pieces are left out.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found: dict[bytes, tuple[float, int]] = {}
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            continue
        text = model.id_to_piece(i)
        data = bytes([int(text[3:5], 16)]) if model.is_byte(i) else text.replace("▁", " ").encode()
        entry = (model.get_score(i) - 1e9 * model.is_byte(i), -i)
        found[data] = max(found.get(data, entry), entry)
    for byte in range(256):
        found.setdefault(bytes([byte]), (-2e9, 0))
    pieces = sorted(found, key=lambda p: (-found[p][0], p))
    scores = np.array([found[p][0] for p in pieces])
    real = scores[scores > -1e8]
    if len(real) and real.max() <= 0 and abs(np.exp(real).sum() - 1) < 0.1:
        log_probs = np.maximum(scores, real.min() - 10)
    else:
        log_probs = -np.log(np.arange(len(pieces)) + 1 + RANK_OFFSET)
    log_probs = log_probs - np.log(np.exp(log_probs).sum())
    return Vocabulary.of(pieces, [-found[p][1] for p in pieces], log_probs)


@dataclass
class Lattices:
    """The lattices of several words, node after node.

    Word w has the nodes ``first[w]`` to ``last[w]``, one per byte position. Arcs are
    sorted by the falling position of their start in the word, then by start node and size;
    ``levels`` says where each position begins, so that all words advance together.
    """

    first: np.ndarray
    last: np.ndarray
    start: np.ndarray
    end: np.ndarray
    piece: np.ndarray
    levels: np.ndarray

    @property
    def nodes(self) -> int:
        return int(self.last[-1]) + 1 if len(self.last) else 0


def lattices(words: list[bytes], trie: Trie) -> Lattices:
    """Every way to write the words as pieces."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    first = np.cumsum(sizes + 1) - (sizes + 1)
    spelled = np.frombuffer(b"".join(words), np.uint8)
    nodes = len(spelled) + len(words)
    at = np.arange(len(spelled)) + np.repeat(np.arange(len(words)), sizes)
    data = np.zeros(nodes, np.uint64)  # 0 at a word's end
    data[at] = spelled.astype(np.uint64) + np.uint64(1)
    key = np.zeros(len(at), np.uint64)
    counts = np.zeros(nodes, np.int64)
    none = [np.zeros(0, np.int64)]
    starts, ends, pieces, ranks = [*none], [*none], [*none], [*none]
    for size in range(1, trie.longest + 1):
        byte = data[at + size - 1]
        with np.errstate(over="ignore"):
            key = key * _FACTOR + byte
        found = trie.find(key)
        found[byte == 0] = -2
        hit = np.flatnonzero(found >= 0)
        node = at[hit]
        starts.append(node)
        ends.append(node + size)
        pieces.append(found[hit])
        ranks.append(counts[node])
        counts[node] += 1
        on = np.flatnonzero(found > -2)
        at, key = at[on], key[on]
        if not len(at):
            break
    # Every arc goes straight to its place: behind those of nodes ahead of its own, then by size.
    highest = int(sizes.max(initial=0))
    falling = highest - (np.arange(nodes) - np.repeat(first, sizes + 1))
    order = np.argsort(falling.astype(np.min_scalar_type(highest)), kind="stable")
    until = np.cumsum(counts[order])
    begin = np.empty(nodes, np.int64)
    begin[order] = until - counts[order]
    s = np.concatenate(starts)
    place = begin[s] + np.concatenate(ranks)
    start, end, piece = np.empty((3, len(s)), np.int64)
    start[place], end[place], piece[place] = s, np.concatenate(ends), np.concatenate(pieces)
    levels = np.append(0, until)[np.cumsum(np.bincount(falling, minlength=highest + 1))]
    return Lattices(first, first + sizes, start, end, piece, np.append(0, levels))


def forward(words: Lattices, log_probs: np.ndarray) -> np.ndarray:
    """Log of the summed probability of all ways to reach every node.

    ``log_probs`` has a row per piece and a column per model.
    """
    reached = np.full((words.nodes, log_probs.shape[1]), -np.inf)
    reached[words.first] = 0.0
    # By position of the end, end and size, in one number that no two arcs share.
    position = words.end - np.repeat(words.first, words.last - words.first + 1)[words.end]
    sizes = words.end - words.start
    key = position * (words.nodes + 1) + words.end
    order = np.argsort(key * (sizes.max(initial=0) + 1) + sizes)
    start, end, piece = words.start[order], words.end[order], words.piece[order]
    cuts = np.flatnonzero(np.diff(position[order], prepend=-1, append=-1))
    for a, b in zip(cuts[:-1], cuts[1:]):
        heads = np.flatnonzero(np.diff(end[a:b], prepend=-1))
        steps = reached[start[a:b]] + log_probs[piece[a:b]]
        reached[end[a:b][heads]] = np.logaddexp.reduceat(steps, heads, axis=0)
    return reached


def backward(words: Lattices, log_probs: np.ndarray) -> np.ndarray:
    """Log of the summed probability of all ways from every node to its word's end."""
    ahead = np.full((words.nodes, log_probs.shape[1]), -np.inf)
    ahead[words.last] = 0.0
    # By falling start position, so that all that follows a node is known.
    for a, b in zip(words.levels[:-1], words.levels[1:]):
        if a < b:
            starts = words.start[a:b]
            heads = np.flatnonzero(np.diff(starts, prepend=-1))
            steps = ahead[words.end[a:b]] + log_probs[words.piece[a:b]]
            ahead[starts[heads]] = np.logaddexp.reduceat(steps, heads, axis=0)
    return ahead


def marginals(words: list[bytes], trie: Trie, log_probs: np.ndarray) -> np.ndarray:
    """Log probability of every word, summed over all its segmentations, per model."""
    lattice = lattices(words, trie)
    return forward(lattice, log_probs)[lattice.last]


def expected_counts(
    words: list[bytes], weights: np.ndarray, trie: Trie, log_probs: np.ndarray
) -> np.ndarray:
    """How often every piece is used, in expectation over the segmentations of words
    that occur ``weights`` times (a row per word, a column per model)."""
    lattice = lattices(words, trie)
    reached, ahead = forward(lattice, log_probs), backward(lattice, log_probs)
    owner = np.repeat(np.arange(len(words)), lattice.last - lattice.first + 1)[lattice.start]
    whole = reached[lattice.last][owner]
    share = np.exp(reached[lattice.start] + log_probs[lattice.piece] + ahead[lattice.end] - whole)
    share *= weights[owner]
    out = np.empty_like(log_probs)
    for model in range(log_probs.shape[1]):
        out[:, model] = np.bincount(lattice.piece, share[:, model], len(log_probs))
    return out
