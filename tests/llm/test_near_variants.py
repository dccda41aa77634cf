"""Near duplicates among many variants of one template, against all pairs."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from starmill.llm import near_dedup
from starmill.llm.components import components


def variants(n: int, changed: int, seed: int, groups: int) -> list[str]:
    """Texts that share a template and, within a group, a tail; each has own words."""
    draw = random.Random(seed)
    template = [f"t{draw.randrange(10**6)}" for _ in range(100)]
    tails = [[f"g{g}x{i}" for i in range(6)] for g in range(groups)]
    rows = []
    for i in range(n):
        words = list(template)
        for k in range(changed):
            words[draw.randrange(0, 100)] = f"v{draw.randrange(n * 3)}"
        rows.append(" ".join(words + tails[i % groups]))
    return rows


def plain_components(texts: list[str], words: int, percent: int) -> list[int]:
    sets = []
    for t in texts:
        w = t.split()
        sets.append({" ".join(w[i : i + words]) for i in range(len(w) - words + 1)})
    often = {s for s, n in Counter(s for x in sets for s in x).items() if n > 1}
    index = {s: i for i, s in enumerate(often)}
    held = np.zeros((len(sets), len(index)), np.float32)
    for i, x in enumerate(sets):
        held[i, [index[s] for s in x if s in index]] = 1
    shared = held @ held.T
    sizes = np.array([len(x) for x in sets])
    linked = 100 * shared >= percent * (sizes[:, None] + sizes[None, :] - shared)
    group = list(range(len(sets)))

    def find(i):
        while group[i] != i:
            group[i] = group[group[i]]
            i = group[i]
        return i

    for a, b in zip(*np.nonzero(linked)):
        group[max(find(a), find(b))] = min(find(a), find(b))
    return [int(find(i)) for i in range(len(sets))]


@pytest.mark.parametrize(
    ("n", "changed", "groups", "percent"),
    [(3000, 4, 1, 85), (600, 3, 20, 85), (400, 2, 10, 85), (400, 1, 3, 85), (600, 4, 12, 80)],
)
def test_variants_of_a_template(spark, monkeypatch, n, changed, groups, percent):
    """Links equal those of all pairs, from candidates in proportion to the rows."""
    texts = variants(n, changed, n + changed, groups)
    compared = []
    estimate = near_dedup._likely
    monkeypatch.setattr(near_dedup, "_likely", lambda p, c, t: compared.append(p.count()) or estimate(p, c, t))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = near_dedup.near_duplicates(docs, 3, percent).orderBy("doc_id").collect()
    assert [r.component_id for r in found] == plain_components(texts, 3, percent)
    # Variants just under the threshold meet more often.
    assert sum(compared) < (12 if groups == 1 else 60) * n


def test_components_of_a_star_and_a_chain(spark, monkeypatch):
    links = [(0, i) for i in range(1, 500)] + [(1000 + i, 1001 + i) for i in range(60)] + [(7, 7)]
    df = spark.createDataFrame(links, "a long, b long")
    found = {r.id: r.component for r in components(df).collect()}
    assert found == {i: 0 for i in range(500)} | {1000 + i: 1000 for i in range(61)}


def test_components_of_stars_need_no_round(spark, monkeypatch):
    from starmill.llm import components as module

    written = []
    write = module.stored
    monkeypatch.setattr(module, "stored", lambda df, label: written.append(label) or write(df, label))
    links = [(0, i) for i in range(1, 50)] + [(i, 100) for i in range(101, 120)] + [(5, 0)]
    found = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(50)} | {i: 100 for i in range(100, 120)}
    assert written == ["links"]
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
    assert len(written) == 2
