"""The prefix trie against plain Python, with nodes across many borders."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from starmill.llm import prefix_trie
from starmill.llm.prefix_trie import SparseMinima, prefix_trie as trie

SCHEMA = "conv_id long, turn long, role string, text string, key string, n long, owner int"


def plain(rows: list[tuple]) -> list[tuple]:
    turns: dict[int, list] = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [t[1:] for t in sorted(v, key=lambda t: t[0])] for c, v in turns.items()}
    rebuilt = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = own.get(c - c % 5, [])[:h] + mine[h:]
    members: dict[tuple, list] = {}
    for c, sequence in rebuilt.items():
        for d in range(len(sequence) + 1):
            members.setdefault(tuple(sequence[:d]), []).append(c)
    children: dict[tuple, int] = {}
    for node in members:
        if node:
            children[node[:-1]] = children.get(node[:-1], 0) + 1
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node, convs in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(convs) - 1) * len(node[-1][1].encode()) if node else 0
    out = []
    for node, convs in members.items():
        ends = ",".join(map(str, sorted(c for c in convs if len(rebuilt[c]) == len(node))))
        parent = min(members[node[:-1]]) if node else None
        out.append(
            (min(convs), len(node), parent, len(convs), children.get(node, 0), leaves[node], saved[node],
             hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(out, key=repr)


def talk(seed: int, convs: int, words: str = "ab") -> list[tuple]:
    draw = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(draw.randint(1, 12)):
            rows.append((c * draw.choice([1, 1, 3]), t, draw.choice(["user", "é"]), draw.choice(words)))
    seen, unique = set(), []
    for r in rows:
        if r[:2] not in seen:
            seen.add(r[:2])
            unique.append(r)
    return unique


AWKWARD = [
    (0, 0, "user", "hello"), (0, 1, None, "x"), (0, None, "user", "first"), (None, 0, "user", "gone"),
    (1, 0, "user", None), (2, 0, "", ""), (3, 5, "user", "hello"), (3, 5, "user", "hello"), (-7, 0, "u", "neg"),
    (4, 0, "user", "long" * 5000), (10, 0, "a:", "b"), (11, 0, "a", ":b"), (12, 2, "user", "é" * 9),
    *[(100 + i, t, "user", f"same {t}") for i in range(30) for t in range(10)],
    *[(200, t, "user", f"same {t}") for t in range(150)],
    *[(201, t, "user", f"same {t}") for t in range(149)],
]


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize(
    "rows", [AWKWARD, talk(1, 60), talk(2, 40, "abcdefgh"), [(7, 0, "u", "t")], [(9, 3, None, None)]],
    ids=["awkward", "crowded", "wide", "one", "empty"],
)
@pytest.mark.parametrize("parts", [1, 4, 13])
def test_nodes_equal_plain_python(spark, monkeypatch, rows, parts):
    monkeypatch.setattr(prefix_trie, "LEAST_RANGES", parts)
    df = spark.createDataFrame([(*r, "k", 1, 2) for r in rows], SCHEMA).repartition(3)
    assert found(trie(df)) == plain(rows)


def test_crossing_nodes_met_by_a_merge(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "FEW_OPEN", 0)
    rows = talk(3, 30)
    df = spark.createDataFrame([(*r, "k", 1, 2) for r in rows], SCHEMA)
    assert found(trie(df)) == plain(rows)


def test_no_conversations(spark):
    assert found(trie(spark.createDataFrame([], SCHEMA))) == []


def test_sparse_minima():
    draw = np.random.default_rng(4)
    values = draw.integers(0, 6, 37)
    table = SparseMinima(values)
    for i in range(37):
        for bound in range(7):
            at, b = np.array([i]), np.array([bound])
            end = i
            while end + 1 < 37 and values[end + 1] >= bound:
                end += 1
            begin = i
            while begin > 0 and values[begin] >= bound:
                begin -= 1
            assert table.reach_right(at, b)[0] == end
            # Value 0 belongs to the step from the first entry to what lies before it.
            assert max(table.reach_left(at, b)[0], 0) == begin
        for j in range(i, 37):
            assert table.least(np.array([i]), np.array([j]))[0] == values[i : j + 1].min()
