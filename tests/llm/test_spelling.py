"""Spelling variants against plain Python."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from starmill.llm import spelling
from starmill.llm.spelling import near_words, spelling_variants

SCHEMA = "doc_id long, text string, word string, n int, prefix string"


def plain_words(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def one_edit(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain(rows):
    words = plain_words(rows)
    forms, out = {}, {}
    for w, n in words.items():
        near = sorted((v for v in words if one_edit(w, v)), key=lambda v: (-words[v], v))
        if near and words[near[0]] >= 10 * n:
            forms[w] = near[0]
        out[w] = len(near)
    result = []
    for w, n in words.items():
        root = w
        while root in forms:
            root = forms[root]
        form = forms.get(w)
        result.append((w, form, root, n, out[w], words.get(form)))
    return sorted(result)


def prose(seed: int, docs: int) -> list[tuple]:
    draw = random.Random(seed)
    stems = ["".join(draw.choices("abéÿ", k=draw.randint(6, 9))) for _ in range(40)]
    rows = []
    for d in range(docs):
        words = [draw.choice(stems[:3]) if draw.random() < 0.7 else draw.choice(stems) for _ in range(300)]
        words = [w.upper() if draw.random() < 0.1 else w for w in words]
        rows.append((d, " ".join(words)))
    return rows


CHAIN = (
    [("aaaaaaa", 3000), ("aaaaaab", 300), ("aaaaabb", 30), ("aaaabbb", 3), ("aaaaaaab", 30), ("aaaaaaaa", 300)]
    + [("zzzzzzz", 9), ("zzzzzzzz", 90), ("zzzzzzy", 90)]
)
AWKWARD = [
    (0, None), (1, ""), (None, "nameless nameless"), (None, "nameless"), (2, "one two"), (3, "STRASSE Straße straße STRAßE"),
    (3, "STRASSE Straße straße STRAßE"), (4, "×÷multiply multiply× xé" * 3), (5, "abcdefg" * 3000),
    (6, "don't-stopping stopping_now stopping"), (7, "İstanbul istanbul Kelvins"), (8, "漢字漢字漢字漢字漢字 漢字漢字漢字漢字"),
    *[(100 + i, " ".join([w] * n)) for i, (w, n) in enumerate(CHAIN)],
]


def found(df):
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()))


@pytest.mark.parametrize("rows", [AWKWARD, prose(1, 30), prose(2, 120)], ids=["awkward", "few", "more"])
def test_variants_equal_plain_python(spark, monkeypatch, rows):
    monkeypatch.setattr(spelling, "HELD", 5)
    docs = spark.createDataFrame([(*r, "w", 1, "p") for r in rows], SCHEMA).repartition(3)
    assert found(spelling_variants(docs)) == plain(rows)


def test_forms_are_followed_to_the_last(spark):
    docs = spark.createDataFrame([(*r, "w", 1, "p") for r in AWKWARD], SCHEMA)
    roots = {r.word: r.root for r in spelling_variants(docs).collect()}
    assert roots["aaaabbb"] == roots["aaaaabb"] == "aaaaaaa"


def test_near_words_come_once_each_way(spark):
    draw = random.Random(6)
    words = list({"".join(draw.choices("abÿ", k=draw.randint(7, 8))) for _ in range(400)})
    df = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "word string, n long")
    pairs = [(r.word, r.near) for r in near_words(df.repartition(5)).collect()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(a, b) for a in words for b in words if one_edit(a, b)}


def test_no_documents(spark):
    assert found(spelling_variants(spark.createDataFrame([], SCHEMA))) == []
