"""Near-duplicate documents by SimHash fingerprints and tables of pivot distances."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from starmill.llm.common import mix64, ship_package, stored, utf8
from starmill.llm.components import components

#: Words of a shingle and seed of its hash.
SHINGLE_WORDS, SEED = 4, 42
#: Differing bits up to which fingerprints link.
DISTANCE = 4
#: Reference fingerprints whose distances decide which pairs are worth a look.
PIVOTS = mix64(np.arange(1, 33, dtype=np.uint64), 77)
#: Fingerprints up to which 6 blocks of bits keep groups small; beyond it 8 do.
FEW = 1 << 27
#: Members of a group that one cell of the search holds; larger groups are dealt over
#: cells of two parts each.
PART = 16_384
#: Groups up to which all pairs of one distance in the list are looked at in one go.
SMALL = 32
#: Bytes of a text worked on at once, and shingles.
CHUNK, VOTES = 1 << 22, 1 << 16

_SPACE = re.compile(rb"[\x20\x09-\x0d]")


def shingle_hashes(text: bytes) -> Iterator[np.ndarray]:
    """XXH64 of all shingles of a text, repeats included, piece by piece.

    Words are what ASCII white space separates, A-Z in lower case. A shorter text is one
    shingle; a text without words has none.
    """
    words: list[bytes] = []
    some, at = False, 0
    while at < len(text):
        end = at + CHUNK
        if end < len(text):
            gap = _SPACE.search(text, end)
            end = gap.start() if gap else len(text)
        words += text[at:end].lower().split()
        at = end
        if len(words) >= SHINGLE_WORDS:
            some = True
            yield _hashed(words)
            words = words[1 - SHINGLE_WORDS :]
    if words and not some:
        yield np.array([xxh64_intdigest(b" ".join(words), SEED)], np.uint64)


def _hashed(words: list[bytes]) -> np.ndarray:
    joined = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    starts = [0, *ends]
    spans = zip(starts, ends[SHINGLE_WORDS - 1 :])
    found = [xxh64_intdigest(joined[a : b - 1], SEED) for a, b in spans]
    return np.array(found, np.uint64)


def fingerprint(text: bytes) -> int:
    """64 bits, each set if it is set in over half the shingle hashes."""
    n, votes = 0, np.zeros(64, np.int64)
    for hashes in shingle_hashes(text):
        n += len(hashes)
        for i in range(0, len(hashes), VOTES):
            octets = hashes[i : i + VOTES].astype("<u8").view(np.uint8).reshape(-1, 8)
            votes += np.unpackbits(octets, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > n, bitorder="little").tobytes(), "little")


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, print) of every row; a null text or one without words has print 0."""

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t.as_py()) for t in batch.column("text")]
            signed = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), signed], ["doc_id", "print"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("text"))
    return rows.mapInArrow(prints, "doc_id long, print long")


def block_keys(prints: int) -> list[int]:
    """Masks of bits, one of which any two linked fingerprints agree in.

    The bits are cut into more blocks than may differ, so at least ``blocks - DISTANCE``
    blocks are equal; there is a mask for every choice of that many. More fingerprints
    take longer masks, so that groups stay small.
    """
    blocks = 6 if prints <= FEW else 8
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    parts = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(parts, blocks - DISTANCE)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def _dealt(prints: DataFrame, masks: list[int], part: int) -> DataFrame:
    """(cell, print): the fingerprints that are compared with each other.

    One cell per mask and value of its bits. A value that more than ``part``
    fingerprints have is dealt over parts, and any two parts meet in a cell, so that no
    cell grows with the group.
    """
    group = [F.xxhash64(F.lit(i), F.col("print").bitwiseAND(F.lit(_signed(m)))) for i, m in enumerate(masks)]
    keyed = prints.select("print", F.explode(F.array(*group)).alias("value"))
    sizes = keyed.groupBy("value").agg(F.count("*").alias("n")).where(F.col("n") > part)
    large = stored(sizes.select("value", F.ceil(F.col("n") / part).cast("int").alias("parts")), "large-prints")
    own = F.pmod(F.xxhash64("print"), F.col("parts")).cast("int")
    others = F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: j != own)
    met = F.transform(others, lambda j: F.xxhash64("value", F.least(own, j), F.greatest(own, j)))
    cells = F.when(F.col("parts").isNull(), F.array("value")).otherwise(met)
    return keyed.join(large, "value", "left").select(F.explode(cells).alias("cell"), "print")


def pivot_table(prints: np.ndarray) -> np.ndarray:
    """Hamming distances to the pivots, a row per fingerprint."""
    return np.bitwise_count(prints[:, None] ^ PIVOTS[None, :]).astype(np.int8)


def surviving(table: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Places of the pairs whose largest difference of pivot distances allows a link.

    Distances obey the triangle inequality: no pair with a larger difference for any
    pivot can be within DISTANCE of each other.
    """
    left = np.arange(len(a))
    for pivot in range(table.shape[1]):
        column = table[:, pivot]
        left = left[np.abs(column[a[left]] - column[b[left]]) <= DISTANCE]
        if not len(left):
            break
    return left


def _linked(prints: np.ndarray, table: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    left = surviving(table, a, b)
    a, b = a[left], b[left]
    close = np.bitwise_count(prints[a] ^ prints[b]) <= DISTANCE
    return a[close], b[close]


def small_groups(prints: np.ndarray, table: np.ndarray, room: np.ndarray) -> Iterator[tuple]:
    """Links within consecutive groups; ``room`` counts the members after each."""
    for step in range(1, SMALL):
        a = np.flatnonzero(room >= step)
        if not len(a):
            return
        yield _linked(prints, table, a, a + step)


def spanning_links(prints: np.ndarray, table: np.ndarray) -> Iterator[tuple]:
    """Links of one group that connect what all its links connect, fewer than members.

    Grows one component at a time: each reached member is compared with those that are
    not reached yet.
    """
    left = np.arange(len(prints))
    while len(left):
        reached, left = [int(left[0])], left[1:]
        while reached and len(left):
            one = reached.pop()
            a, b = _linked(prints, table, np.full(len(left), one), left)
            if len(b):
                yield a, b
                reached.extend(b.tolist())
                left = np.setdiff1d(left, b, assume_unique=True)


def cell_links(cells: np.ndarray, prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Linked fingerprints of complete cells that lie one after the other."""
    starts = np.flatnonzero(np.diff(cells, prepend=cells[0] - 1 if len(cells) else 0))
    sizes = np.diff(np.append(starts, len(cells)))
    several = np.repeat(sizes > 1, sizes)
    prints, sizes = prints[several], sizes[sizes > 1]
    if not len(prints):
        return
    table = pivot_table(prints)
    ends = np.cumsum(sizes)
    room = np.repeat(ends, sizes) - 1 - np.arange(len(prints))
    few = np.repeat(sizes <= SMALL, sizes)
    for a, b in small_groups(prints, table, np.where(few, room, 0)):
        yield prints[a], prints[b]
    for size, end in zip(sizes[sizes > SMALL].tolist(), ends[sizes > SMALL].tolist()):
        inside = slice(end - size, end)
        for a, b in spanning_links(prints[inside], table[inside]):
            yield prints[inside][a], prints[inside][b]


def link_fingerprints(prints: DataFrame, part: int = PART) -> DataFrame:
    """Links (a, b) that connect all distinct ``print`` values within DISTANCE bits.

    Distances to reference fingerprints concentrate around 32, so they tell pairs apart
    but do not say who should meet: fingerprints meet where enough blocks of their bits
    agree, which no linked pair can avoid. Among those that meet, pairs are discarded by
    the largest difference of their pivot distances and the survivors verified. Crowded
    groups give links that span their components instead of all pairs.
    """
    masks = block_keys(prints.count())
    dealt = _dealt(prints, masks, part).repartition("cell").sortWithinPartitions("cell", "print")

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(cells, held):
            for a, b in cell_links(cells, held.view(np.uint64)):
                yield pa.RecordBatch.from_pydict({"a": a.view(np.int64), "b": b.view(np.int64)})

        cells, held = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            if not len(batch):
                continue
            cells = np.concatenate([cells, batch.column("cell").to_numpy()])
            held = np.concatenate([held, batch.column("print").to_numpy()])
            whole = int(np.searchsorted(cells, cells[-1], side="left"))
            if whole:
                yield from found(cells[:whole], held[:whole])
                cells, held = cells[whole:], held[whole:]
        if len(cells):
            yield from found(cells, held)

    return dealt.mapInArrow(links, "a long, b long")


def simhash_components(docs: DataFrame, part: int = PART) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every row.

    Fingerprints link at DISTANCE or fewer differing bits; a component is what links
    connect and component_id its smallest doc_id. A null text or one without words has
    fingerprint zero and links like any other. Rows that share a doc_id belong together.
    A row without a doc_id links too, but names no component: component_id is null where
    no row of the component has a doc_id. Empty tables give no rows; other columns are
    ignored, whatever their names.
    """
    ship_package(docs.sparkSession)
    rows = stored(fingerprint_documents(docs), "fingerprints")
    classes = stored(rows.groupBy("print").agg(F.min("doc_id").alias("first")), "prints")
    links = link_fingerprints(classes.select("print"), part)
    ends = rows.where(F.col("doc_id").isNotNull()).groupBy("doc_id")
    several = ends.agg(F.min("print").alias("a"), F.max("print").alias("high")).where("a < high")
    several = several.select("doc_id", "a").join(rows, "doc_id").select("a", F.col("print").alias("b"))
    connected = components(links.union(several))
    root: Column = F.coalesce("component", "print")
    rooted = classes.join(connected, F.col("print") == F.col("id"), "left").select("print", "first", root.alias("root"))
    rooted = stored(rooted, "rooted-prints")
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.select("print", "root").join(least, "root").select("print", "component_id")
    digits = F.lpad(F.lower(F.hex("print")), 16, "0")
    return rows.join(named, "print").select("doc_id", digits.alias("fingerprint"), "component_id")
