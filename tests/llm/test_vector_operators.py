"""Vector searches against brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from starmill.llm import cross_polytope, vector_topk


@pytest.fixture(scope="module")
def table(spark):
    """300 vectors with repeats and ties, and every kind that takes no part."""
    draw = np.random.default_rng(2)
    data = draw.normal(size=(300, 24)).round(1)
    data[50:80] = data[0]
    rows = [(i, v.tolist()) for i, v in enumerate(data)]
    rows += [
        (400, None), (401, []), (402, [1.0] * 23 + [None]), (403, [math.nan] * 24),
        (404, [math.inf] + [0.0] * 23), (None, [1.0] * 24), (405, [1.0, 2.0]), (420, [0.0] * 24),
    ]
    return spark.createDataFrame(rows, "vec_id long, vector array<double>").repartition(4), data


def best(scores, own, k=20):
    return sorted((-s, j) for j, s in enumerate(scores) if j != own)[:k]


def test_exact_search(table):
    df, data = table
    usable = df.where(vector_topk.usable(F.col("vector")))
    whole = usable.select("vec_id", vector_topk.scaled(F.col("vector"), 64).alias("vector"))
    asked = whole.where("vec_id % 20 = 0")
    found: dict[int, list] = {}
    for r in vector_topk.top_k_products(whole, asked, block_rows=64, query_rows=7).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.score, r.vec_id))
    numbers = np.floor(64 * data).astype(int)
    numbers = np.vstack([numbers, np.full((120, 24), -(10**6))])
    for q in range(0, 300, 20):
        scores = numbers[:300] @ numbers[q]
        expected = best([*scores, *[-(10**12)] * 120, 0], q)  # 420 is the zero vector
        got = [(-s, v) for _, s, v in sorted(found[q])]
        assert got == expected
    assert sorted(found) == [*range(0, 300, 20), 420]


@pytest.mark.parametrize("dim, bits", [(16, 4), (7, 3), (1, 1)])
def test_bounds_hold_and_come_from_the_cells(dim, bits):
    draw = np.random.default_rng(3)
    data = draw.integers(-200, 200, (500, dim))
    queries = draw.integers(-200, 200, (20, dim))
    file = vector_topk.VectorApproximation(data, bits)
    bounds = file.upper_bounds(queries)
    # What is scanned takes half a byte for every dimension, and bounds are no looser
    # than the cells are wide.
    assert file.cells.dtype == np.uint8 and file.cells.nbytes == 500 * ((dim + 1) // 2)
    assert (bounds >= queries @ data.T).all()
    widest = max(np.ptp(np.sort(data[:, d])[i : i + 500 // 2**bits + 30]) for d in range(dim) for i in range(500))
    assert (bounds - queries @ data.T <= np.abs(queries).sum(axis=1, keepdims=True) * widest + 1).all()


def recall(spark, data, k=20, **options):
    """Share of true neighbours found for every twentieth vector; ranks and scores hold."""
    rows = [(i, v.tolist()) for i, v in enumerate(data)]
    df = spark.createDataFrame(rows, "vec_id long, vector array<double>").repartition(4)
    asked = df.where("vec_id % 20 = 0")
    got: dict[int, list] = {}
    for r in cross_polytope.nearest_products(df, asked, k, **options).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hits = total = 0
    for q in range(0, len(data), 20):
        found = sorted(got[q])
        assert [g[0] for g in found] == list(range(1, min(k, len(data) - 1) + 1))
        assert all(abs(s - data[v] @ data[q]) < 1e-9 for _, v, s in found)
        assert all(a[2] > b[2] - 1e-12 for a, b in zip(found, found[1:]))
        true = {j for _, j in best(data @ data[q], q, k)}
        hits, total = hits + len({v for _, v, _ in found} & true), total + len(true)
    return hits / total


@pytest.mark.parametrize("norms", ["equal", "one long", "lognormal"])
def test_approximate_search_finds_most_whatever_the_norms(spark, norms):
    draw = np.random.default_rng(5)
    data = draw.normal(size=(3000, 64))
    data /= np.linalg.norm(data, axis=1, keepdims=True)
    if norms == "one long":
        data[7] *= 10
    elif norms == "lognormal":
        data *= np.exp(draw.normal(0, 0.5, (3000, 1)))
    assert recall(spark, data) >= 0.9


def test_small_tables_are_searched_whole(spark):
    draw = np.random.default_rng(6)
    assert recall(spark, draw.normal(size=(15, 64)) * np.exp(draw.normal(0, 3, (15, 1)))) == 1


def test_queries_left_with_too_few_search_everything(spark):
    """All vectors but one look away from it."""
    data = np.tile(np.eye(16)[0], (400, 1)) + np.random.default_rng(7).normal(0, 0.01, (400, 16))
    data[0] *= -1
    assert recall(spark, data, probe_share=0.05, tables=2, bucket_rows=64) >= 0.9


def test_vectors_that_take_no_part(table):
    df, _ = table
    rows = cross_polytope.nearest_products(df, df).collect()
    ids = {r.query_id for r in rows} | {r.vec_id for r in rows}
    assert ids == set(range(300))  # 405 has another length and finds nothing


def test_bands_hold_at_the_ends_of_the_range(spark):
    rows = [(1, [1e300, 1e300]), (2, [1e-300, 0.0]), (3, [5e-324, 0.0]), (4, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, vector array<double>")
    got = cross_polytope.nearest_products(df, df.where("vec_id = 4")).collect()
    assert [r.vec_id for r in sorted(got, key=lambda r: r["rank"])] == [1, 2, 3]


def test_no_vectors(spark):
    none = spark.createDataFrame([], "vec_id long, vector array<double>")
    assert cross_polytope.nearest_products(none, none).count() == 0
    assert vector_topk.top_k_products(none, none).count() == 0
