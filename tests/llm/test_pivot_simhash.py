"""SimHash components against plain Python."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from starmill.llm import pivot_simhash
from starmill.llm.pivot_simhash import fingerprint, simhash_components

SCHEMA = "doc_id long, text string, print string, component string, root int"


def plain_print(text: str | None) -> int:
    words = (text or "").encode().lower().split()
    if len(words) >= 4:
        shingles = [b" ".join(words[i : i + 4]) for i in range(len(words) - 3)]
    else:
        shingles = [b" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows: list[tuple]) -> list[tuple]:
    prints = [plain_print(t) for _, t in rows]
    group = list(range(len(rows)))

    def find(i):
        while group[i] != i:
            group[i] = group[group[i]]
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            same = rows[i][0] is not None and rows[i][0] == rows[j][0]
            if same or (prints[i] ^ prints[j]).bit_count() <= 4:
                group[find(i)] = find(j)
    least: dict[int, int] = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return [(d, f"{p:016x}", least.get(find(i))) for i, ((d, _), p) in enumerate(zip(rows, prints))]


def text(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(["alpha", "Beta", "gamma", "delta", "é", "zeta", "eta"]) for _ in range(n))


def awkward() -> list[tuple]:
    base = text(1, 300)
    rows = [
        (0, base), (1, base), (2, base.replace("alpha", "omega", 1)), (3, None), (4, ""), (5, " \n\t"),
        (6, "one two"), (7, "ONE  two"), (8, text(2, 40)), (8, text(3, 40)), (8, text(4, 40)),
        (9, text(4, 40)), (None, base), (None, text(9, 50)), (-5, text(5, 4000)), (10, text(5, 4000) + " x"),
        (11, "a b c\x0bd e\x0cf"), (12, "a b c d e f"), (8, text(2, 40)),
    ]
    # A chain of near copies, each some bits off the one before.
    words = text(6, 250).split()
    for i in range(60):
        words[(i * 37) % 250] = f"w{i}"
        rows.append((100 + i, " ".join(words)))
    return rows


def found(df):
    return sorted(map(tuple, df.select("doc_id", "fingerprint", "component_id").collect()), key=repr)


@pytest.mark.parametrize("part", [pivot_simhash.PART, 7])
def test_components_equal_plain_python(spark, part):
    rows = awkward()
    docs = spark.createDataFrame([(d, t, "x", "y", 1) for d, t in rows], SCHEMA).repartition(3)
    assert found(simhash_components(docs, part)) == sorted(plain_components(rows), key=repr)


def test_no_documents(spark):
    assert simhash_components(spark.createDataFrame([], SCHEMA)).count() == 0


def test_long_texts_are_hashed_piece_by_piece(monkeypatch):
    monkeypatch.setattr(pivot_simhash, "CHUNK", 50)
    monkeypatch.setattr(pivot_simhash, "VOTES", 7)
    for t in (text(7, 500), "a b c", "x" * 200, "x" * 200 + " y z", " " * 120, "a " * 90):
        assert fingerprint(t.encode()) == plain_print(t)


def crowd(n: int, flips: int, seed: int) -> np.ndarray:
    draw = np.random.default_rng(seed)
    prints = np.full(n, draw.integers(2**63), np.uint64)
    for _ in range(flips):
        prints ^= np.uint64(1) << draw.integers(0, 64, n).astype(np.uint64)
    return np.unique(prints)


@pytest.mark.parametrize("prints", [crowd(3000, 5, 1), crowd(500, 9, 2), crowd(2000, 2, 3)])
@pytest.mark.parametrize("part", [pivot_simhash.PART, 200])
def test_crowds_of_near_copies_connect_as_all_their_pairs_do(spark, prints, part):
    """Also dealt over cells; never more links than a few per member, mask and cell."""
    df = spark.createDataFrame([(int(p),) for p in prints.view(np.int64)], "print long").repartition(3)
    links = [(a, b) for a, b in pivot_simhash.link_fingerprints(df, part).collect()]
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 4 for a, b in links)
    assert components_of(prints.view(np.int64).tolist(), links) == brute(prints)
    if part == pivot_simhash.PART:
        assert len(links) <= 15 * pivot_simhash.SMALL / 2 * len(prints)


def components_of(nodes, links):
    group = {n: n for n in nodes}

    def find(i):
        while group[i] != i:
            group[i] = group[group[i]]
            i = group[i]
        return i

    for a, b in links:
        group[find(a)] = find(b)
    sets: dict[int, set] = {}
    for n in nodes:
        sets.setdefault(find(n), set()).add(n)
    return {frozenset(s) for s in sets.values()}


def brute(prints):
    links = []
    for i, p in enumerate(prints):
        near = np.flatnonzero(np.bitwise_count(prints[:i] ^ p) <= 4)
        links += [(int(np.int64(p)), int(q)) for q in prints[near].view(np.int64)]
    return components_of(prints.view(np.int64).tolist(), links)


def test_masks_miss_no_pair_of_four_bits():
    for prints in (1, pivot_simhash.FEW + 1):
        masks = pivot_simhash.block_keys(prints)
        draw = random.Random(5)
        for _ in range(2000):
            differing = sum(1 << b for b in draw.sample(range(64), 4))
            assert any(differing & m == 0 for m in masks)


def test_pivots_keep_every_link():
    prints = crowd(400, 6, 8)
    table = pivot_simhash.pivot_table(prints)
    a, b = map(np.ravel, np.meshgrid(np.arange(len(prints)), np.arange(len(prints))))
    close = set(np.flatnonzero(np.bitwise_count(prints[a] ^ prints[b]) <= 4))
    kept = set(pivot_simhash.surviving(table, a, b))
    assert close <= kept and len(kept) < len(a) / 2
