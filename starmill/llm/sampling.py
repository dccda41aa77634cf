"""Distinct sampled segmentations by perturbed best-first search over the lattice."""

from __future__ import annotations

from collections.abc import Collection, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import batches, mix64, releasing, utf8
from starmill.llm.pieces import Vocabulary, backward, lattices

#: Distinct units whose lattices a task holds; beyond, it forgets those that it met once.
CACHED_UNITS = 150_000
#: Bytes of units whose lattices are worked on together.
CHUNK = 1 << 16

SAMPLED = (
    "doc_id long, rank int, ids binary, n_tokens int, log_prob double, perturbed double, "
    "inclusion double, log_inclusion double"
)
_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("rank", pa.int32()),
        ("ids", pa.binary()),
        ("n_tokens", pa.int32()),
        ("log_prob", pa.float64()),
        ("perturbed", pa.float64()),
        ("inclusion", pa.float64()),
        ("log_inclusion", pa.float64()),
    ]
)


def encode_text(text: bytes) -> bytes:
    """What the lattice spells: a space ahead of the first word, as pieces expect."""
    return b" " + text if text else b""


def decode_ids(ids: bytes, vocabulary: Vocabulary) -> bytes:
    """The text that the ids (unsigned 32-bit, little-endian) stand for."""
    by_id = {int(i): p for i, p in zip(vocabulary.ids, vocabulary.pieces, strict=True)}
    return b"".join(by_id[i] for i in np.frombuffer(ids, "<u4").tolist())[1:]


class Sampler:
    """Lattices of units with the chance of every arc, given the node it leaves.

    A node's arcs lie side by side, each with the running chance of those before it in ``_floor``. No piece of the
    vocabulary may reach over a unit's end, or texts are units whole.
    """

    def __init__(self, vocabulary: Vocabulary, limit: int = CACHED_UNITS):
        self._vocabulary = vocabulary
        self._limit = limit
        self._apart = all(
            b" " not in p.lstrip(b" ") and (b"\n" not in p or p == b"\n") for p in vocabulary.pieces
        )
        self._numbers: dict[bytes, int] = {}
        self._first = self._met = np.zeros(0, np.int64)  # first node, calls that met it; by number
        # Of nodes and arcs there is room for more than are in use.
        self._nodes = self._used = 0
        self._floor = self._chance = np.zeros(0)
        self._next = self._piece = np.zeros(0, np.int32)
        self._arcs = np.zeros(1, np.int64)  # first arc of every node

    def units(self, text: bytes) -> list[bytes]:
        return _values(self._cut([text])[0])

    def _cut(self, texts: list[bytes]) -> tuple[pa.LargeBinaryArray, np.ndarray]:
        """The units of all texts in order, and the first unit of every text.

        A unit is a line break, or a word with the spaces ahead of it, or spaces that no word follows.
        """
        whole = b"".join(texts)
        data = np.frombuffer(whole, np.uint8)
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
        begin = np.append(0, ends)
        heads = np.zeros(len(data) + 1, bool)
        heads[begin] = True
        if self._apart:
            line, space = data == ord("\n"), data == ord(" ")
            heads[:-1] |= line
            heads[1:] |= line
            heads[1:-1] |= space[1:] & ~space[:-1]
        heads[-1] = True
        offsets = np.flatnonzero(heads)
        parts = [None, pa.py_buffer(offsets), pa.py_buffer(whole)]
        units = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, parts)
        return units, np.searchsorted(offsets, begin)

    def learn(self, units: Collection[bytes]) -> None:
        """Hold the lattices of all these units, which are distinct."""
        new = [u for u in units if u not in self._numbers]
        if len(new) + len(self._numbers) > self._limit:
            self._forget(units)
            new = [u for u in units if u not in self._numbers]
        new.sort(key=len)  # words of one chunk advance together
        ends = np.cumsum(np.fromiter(map(len, new), np.int64, len(new)))
        cuts = np.flatnonzero(np.diff(ends // CHUNK, prepend=-1, append=-1))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            self._add(new[a:b])

    def _forget(self, units: Collection[bytes]) -> None:
        """Keep what was met again or is asked for now, unless that is most of it."""
        again = np.flatnonzero(self._met > 1)
        names = list(self._numbers)
        known = [self._numbers[u] for u in units if u in self._numbers]
        kept = np.union1d(again, np.array(known, np.int64))
        if 2 * len(kept) > self._limit:
            kept = np.array(sorted(known), np.int64)
        if 2 * len(kept) > self._limit:
            kept = kept[:0]
        ends = np.append(self._first, self._nodes)
        first, sizes = ends[kept], np.diff(ends)[kept]
        begin = np.cumsum(sizes) - sizes
        nodes = np.repeat(first - begin, sizes) + np.arange(int(sizes.sum()))
        counts = np.diff(self._arcs[: self._nodes + 1])[nodes]
        arcs = np.repeat(self._arcs[nodes] - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
        moved = np.repeat(np.repeat(begin - first, sizes), counts)
        follow = self._next[arcs]
        self._next = np.where(follow < 0, -1, follow + moved).astype(np.int32)
        self._floor, self._chance, self._piece = self._floor[arcs], self._chance[arcs], self._piece[arcs]
        self._arcs = np.concatenate([[0], np.cumsum(counts)])
        self._used = len(arcs)
        self._numbers = {names[i]: n for n, i in enumerate(kept.tolist())}
        self._first, self._nodes = begin, int(sizes.sum())
        self._met = np.ones(len(kept), np.int64)

    def _add(self, units: list[bytes]) -> None:
        lattice = lattices(units, self._vocabulary.trie)
        scores = self._vocabulary.log_probs[:, None]
        ahead = backward(lattice, scores)[:, 0]
        start, end = lattice.start, lattice.end
        chance = np.exp(self._vocabulary.log_probs[lattice.piece] + ahead[end] - ahead[start])
        # A node's arcs lie side by side already, but not in the order of the nodes.
        heads = np.flatnonzero(np.diff(start, prepend=-1))
        sizes = np.diff(heads, append=len(start))
        chance /= np.repeat(np.add.reduceat(chance, heads), sizes)
        floor = np.append(0.0, np.cumsum(chance)[:-1])
        floor -= np.repeat(floor[heads], sizes)
        counts = np.zeros(lattice.nodes, np.int64)
        counts[start[heads]] = sizes
        arcs = np.cumsum(counts)
        place = np.arange(self._used, self._used + len(start)) + np.repeat((arcs - counts)[start[heads]] - heads, sizes)
        last = np.zeros(lattice.nodes, bool)
        last[lattice.last] = True
        used = self._used + len(start)
        self._floor = _roomy(self._floor, used)
        self._next = _roomy(self._next, used)
        self._piece = _roomy(self._piece, used)
        self._chance = _roomy(self._chance, used)
        self._arcs = _roomy(self._arcs, self._nodes + lattice.nodes + 1)
        self._floor[place] = floor
        self._next[place] = np.where(last[end], -1, end + self._nodes)
        self._piece[place] = lattice.piece
        self._chance[place] = chance
        self._arcs[self._nodes + 1 : self._nodes + lattice.nodes + 1] = arcs + self._used
        self._used = used
        self._numbers.update(zip(units, range(len(self._numbers), len(self._numbers) + len(units))))
        self._first = np.concatenate([self._first, lattice.first + self._nodes])
        self._met = np.concatenate([self._met, np.zeros(len(units), np.int64)])
        self._nodes += lattice.nodes

    def _draw(
        self, nodes: np.ndarray, seeds: np.ndarray, text: np.ndarray, places: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Arcs from every node to its unit's end: arcs in order, and their number for every node.

        The draws of a node depend on its text's seed and its place only.
        """
        owner = np.arange(len(nodes))
        steps = []
        counts = np.zeros(len(nodes), np.int64)
        while len(nodes):
            u = _at(_stream(seeds, len(steps))[text[owner]], places[owner])
            # Down from the node's last arc, as long pieces are likelier than their beginnings.
            arc = self._arcs[nodes + 1] - 1
            high = np.flatnonzero(self._floor[arc] >= u)
            while len(high):
                arc[high] -= 1
                high = high[self._floor[arc[high]] >= u[high]]
            steps.append((owner, arc))
            counts[owner] = len(steps)
            follow = self._next[arc]
            going = np.flatnonzero(follow >= 0)
            nodes, owner = follow[going].astype(np.int64), owner[going]
        begin = np.cumsum(counts) - counts
        arcs = np.empty(int(counts.sum()), np.int64)
        for n, (owner, arc) in enumerate(steps):
            arcs[begin[owner] + n] = arc
        return arcs, counts

    def sample(self, texts: list[bytes], k: int, seeds: list[int]) -> list[list[tuple]]:
        """Per text at most k distinct segmentations: pieces, log probability given the
        text, perturbed log probability (falling) and the chance to be among the k.

        Every set of segmentations with a common beginning has one Gumbel-perturbed log
        probability, the largest of its members'. Drawing a segmentation splits the set
        it stands for at each of its steps into the way taken, which keeps the value,
        and the ways not taken, whose value is drawn below it. The best set left holds
        the next segmentation. All texts draw their next one together.
        """
        units, cuts = self._cut(texts)
        coded = units.dictionary_encode()
        distinct = _values(coded.dictionary)
        self.learn(distinct)
        known = np.fromiter(map(self._numbers.__getitem__, distinct), np.int64, len(distinct))
        self._met[known] += 1
        nodes = self._first[known[coded.indices.to_numpy()]]
        first = [nodes[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
        seed = np.array(seeds, np.int64)
        tops = -np.log(-np.log(_uniform(seed, np.zeros(len(seed), np.int64))))
        searches = [_Search() for _ in texts]
        turns = [_Turn(i, first[i], 0, _NOTHING, 0.0, [], float(tops[i]), 0.0) for i in range(len(texts))]
        for round_ in range(1, k + 1):
            self._extend(searches, turns, seed + 1000 * round_)
            other = _uniform(seed + 1000 * round_, np.zeros(len(seed), np.int64), -1).tolist()
            turns = []
            for i, search in enumerate(searches):
                turn = search.next(round_ == k)
                if turn is not None:
                    turns.append(self._turn(i, turn, first[i], other[i]))
            if not turns:
                break
        return [s.results(self._piece) for s in searches]

    def _turn(self, i: int, found: tuple, first: np.ndarray, draw: float) -> _Turn:
        """Choose another arc at the step where the best set left its path."""
        path, at, before, ruled, top = found
        arcs = range(*self._node_arcs(int(path[at])))
        arcs = np.array([a for a in arcs if a not in ruled])
        running = np.cumsum(self._chance[arcs])
        u = draw * running[-1]
        arc = int(arcs[min(int(np.searchsorted(running, u, side="right")), len(arcs) - 1)])
        ruled = [*ruled, arc]
        left = float(self._chance[[a for a in arcs if a != arc]].sum())
        unit, follow = int(np.count_nonzero(self._next[path[:at]] < 0)), int(self._next[arc])
        nodes = first[unit + 1 :] if follow < 0 else np.concatenate([[follow], first[unit + 1 :]])
        begun = np.append(path[:at], arc)
        return _Turn(i, nodes, unit + (follow < 0), begun, before, ruled, top, left)

    def _node_arcs(self, arc: int) -> tuple[int, int]:
        node = int(np.searchsorted(self._arcs[: self._nodes + 1], arc, side="right")) - 1
        return int(self._arcs[node]), int(self._arcs[node + 1])

    def _extend(self, searches: list[_Search], turns: list[_Turn], seeds: np.ndarray) -> None:
        """Draw every turn's path to its end and value the ways not taken."""
        sizes = np.array([len(t.nodes) for t in turns])
        text = np.repeat([t.text for t in turns], sizes)
        units = np.concatenate([np.arange(t.unit, t.unit + len(t.nodes)) for t in turns])
        nodes = np.concatenate([t.nodes for t in turns]).astype(np.int64)
        arcs, counts = self._draw(nodes, seeds, text, units * 64)
        cuts = np.append(0, np.cumsum(counts))[np.append(0, np.cumsum(sizes))]
        drawn = [arcs[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
        # The step where a path left its set, if it did, and all after it.
        flat = np.concatenate([x for t, d in zip(turns, drawn) for x in (t.begun[-1:], d)])
        split = np.array([len(t.begun) > 0 for t in turns])
        lengths = np.diff(cuts) + split
        ends = np.cumsum(lengths)
        starts = ends - lengths
        of = np.repeat(np.arange(len(turns)), lengths)
        begin = np.array([max(0, len(t.begun) - 1) for t in turns])
        step = np.arange(len(flat)) - (starts - begin)[of]
        chance = self._chance[flat]
        left = 1.0 - chance
        left[starts[split]] = [t.left for t in turns if len(t.begun)]
        summed = np.append(0.0, np.cumsum(np.log(chance)))
        before = np.array([t.before for t in turns]) - summed[starts]
        whole = (before + summed[ends]).tolist()
        before = summed[:-1] + before[of]
        with np.errstate(divide="ignore"):
            mass = before + np.log(np.maximum(left, 0.0))
        u = _at(_stream(seeds, -2)[np.array([t.text for t in turns])][of], step)
        top = np.array([t.top for t in turns])
        with np.errstate(over="ignore"):
            # A Gumbel variable at ``mass`` given that it is below ``top``.
            values = mass - np.log(np.exp(mass - top[of]) - np.log(u))
        for t, d, a, b, log_prob in zip(turns, drawn, starts.tolist(), ends.tolist(), whole):
            path = np.append(t.begun, d)
            searches[t.text].add(path, values[a:b], before[a:b], t.ruled, log_prob, t.top)


_NOTHING = np.zeros(0, np.int64)


class _Turn:
    """A path to be drawn to its end: what it begins with and where it goes on.

    ``before`` is the log probability of what the path shares with the set that it splits.
    """

    __slots__ = ("text", "nodes", "unit", "begun", "before", "ruled", "top", "left")

    def __init__(self, text, nodes, unit, begun, before, ruled, top, left):
        self.text, self.nodes, self.unit, self.begun, self.before = text, nodes, unit, begun, before
        self.ruled, self.top, self.left = ruled, top, left


class _Search:
    """The segmentations found for one text and the sets that hold all others."""

    def __init__(self):
        self._found: list[tuple] = []
        self._open: list[tuple] = []
        self._rest = -np.inf

    def add(self, path, values, before, ruled, log_prob, value) -> None:
        """A path with the values of the sets that leave it at its last steps, and its log probability ahead of them."""
        self._found.append((path, log_prob, value))
        self._open.append((values, before, path, ruled))

    def next(self, last: bool) -> tuple | None:
        """The best set left, unless nothing is or enough was found."""
        values, before, path, ruled = max(self._open, key=lambda o: o[0].max(initial=-np.inf))
        self._rest = float(values.max(initial=-np.inf))
        if last or self._rest == -np.inf:
            return None
        at = int(np.argmax(values))
        values[at] = -np.inf  # split anew by the turn
        step = len(path) - len(values) + at
        ruled = ruled if ruled and at == 0 else [int(path[step])]
        return path, step, float(before[at]), ruled, self._rest

    def results(self, piece: np.ndarray) -> list[tuple]:
        out = []
        for path, log_prob, value in self._found:
            rest = self._rest
            apart = np.inf if rest == -np.inf else log_prob - rest
            # 1 - exp(-exp(apart)), which is exp(apart) itself where that is small.
            inclusion = float(-np.expm1(-np.exp(min(apart, 40.0))))
            log_inclusion = float(apart) if apart < -30 else float(np.log(inclusion))
            out.append((piece[path], log_prob, value, inclusion, log_inclusion))
        return out


def _values(strings: pa.LargeBinaryArray) -> list[bytes]:
    """What ``to_pylist`` returns, at a quarter of its time."""
    _, offsets, data = strings.buffers()
    cuts = np.frombuffer(offsets, np.int64)[strings.offset : strings.offset + len(strings) + 1].tolist()
    whole = data.to_pybytes() if data else b""
    return [whole[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


def _roomy(kept: np.ndarray, size: int) -> np.ndarray:
    """The same with room for ``size`` values at least."""
    if size <= len(kept):
        return kept
    wider = np.empty(size * 3 // 2, kept.dtype)
    wider[: len(kept)] = kept
    return wider


def _uniform(seeds: np.ndarray, places: np.ndarray, stream: int = -3) -> np.ndarray:
    """Numbers above 0 and below 1 that depend on seed, place and stream only.

    Streams are apart: no sum of a seed and a stream stands for another pair of them.
    """
    return _at(_stream(seeds, stream), places)


def _stream(seeds: np.ndarray, stream: int) -> np.ndarray:
    """What all numbers of a seed and a stream begin with."""
    other = mix64(np.array([stream], np.int64).astype(np.uint64), 63)
    return mix64(mix64(seeds, 62) ^ other, 62)


def _at(begun: np.ndarray, places: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        mixed = mix64(places.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ begun, 61)
    return ((mixed >> np.uint64(12)).astype(float) + 0.5) * 2.0**-52


def sample_segmentations(
    docs: DataFrame, vocabulary: Vocabulary, k: int = 3, seed: int = 1
) -> DataFrame:
    """k distinct segmentations of every text, drawn without replacement.

    One row per segmentation: ``doc_id``, ``rank`` from 1, ``ids`` (unsigned 32-bit,
    little-endian), ``n_tokens``, ``log_prob`` given the text, ``perturbed`` (falling
    with the rank) and ``inclusion``, the chance that a draw of k at the threshold found
    holds this one. The draw depends on ``seed`` and ``doc_id`` only, not on partitions.

    A null or empty text has one segmentation without tokens; a text with fewer than k
    segmentations has them all, with inclusion 1. ``log_inclusion`` is its natural
    logarithm, finite also where the chance itself is too small for a double. Repeated rows are drawn alike; a null
    ``doc_id`` is a key of its own; other columns are ignored.
    """
    session = docs.sparkSession
    sent = session.sparkContext.broadcast(vocabulary)
    key = F.xxhash64(F.lit(seed), F.col("doc_id").cast("long")).alias("seed")
    rows = docs.select(F.col("doc_id").cast("long"), key, utf8().alias("text"))

    def draw(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = sent.value
        ids = vocabulary.ids.astype("<u4")
        sampler = Sampler(vocabulary)

        def drawn() -> Iterator[tuple]:
            for whole in parts:
                for at in range(0, len(whole), 512):
                    batch = whole.slice(at, 512)
                    texts = [encode_text(t) for t in batch.column("text").to_pylist()]
                    seeds = [x >> 2 for x in batch.column("seed").to_pylist()]
                    found = sampler.sample(texts, k, seeds)
                    for doc_id, some in zip(batch.column("doc_id").to_pylist(), found, strict=True):
                        for rank, (path, *scores) in enumerate(some, 1):
                            yield doc_id, rank, ids[path].tobytes(), len(path), *scores

        yield from batches(drawn(), _ARROW, 1024)

    return rows.mapInArrow(releasing(draw), SAMPLED)
