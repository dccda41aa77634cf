"""Exact top-k by inner product with a vector-approximation file."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm.common import mix64

#: Vectors of one block: what a task holds of the table at once.
BLOCK_ROWS = 4096
#: Queries of one block.
QUERY_ROWS = 2048
#: Bits of a cell number in every dimension, four at most: two dimensions share a byte.
CELL_BITS = 4
#: Blocks of vectors that one task meets at least, with room for 64 tasks, before there are more.
PARTS, PART_BLOCKS = 64, 64
#: Exact vectors read at a time while a query is refined.
STEP = 64

BLOCK = "dim int, block long, part int, ids binary, vectors binary"
_BLOCK = pa.schema(
    [
        ("dim", pa.int32()),
        ("block", pa.int64()),
        ("part", pa.int32()),
        ("ids", pa.binary()),
        ("vectors", pa.binary()),
    ]
)


def usable(vector: Column) -> Column:
    """Not null, not empty, and every component present and finite."""
    bad = F.exists(
        vector.cast("array<double>"),
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))),
    )
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & ~bad, F.lit(False))


def scaled(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component, computed in double precision."""
    return F.transform(vector.cast("array<double>"), lambda x: F.floor(x * F.lit(float(scale))))


def to_blocks(vectors: DataFrame, size: int, parts: int = 1) -> DataFrame:
    """Integer vectors (vec_id, vector) of one partition in blocks of one dimension."""

    def gather(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        waiting: dict[int, list[tuple]] = {}
        made = 0

        def block(dim: int) -> pa.RecordBatch:
            nonlocal made
            made += 1
            got = waiting.pop(dim)
            ids = np.concatenate([x[0] for x in got]).astype("<i8").tobytes()
            data = np.concatenate([x[1] for x in got]).astype("<i8").tobytes()
            number = TaskContext.get().partitionId() * 2**32 + made
            return pa.RecordBatch.from_pydict(
                {
                    "dim": [dim],
                    "block": [number],
                    "part": [int(mix64(np.array([number]))[0] % np.uint64(parts))],
                    "ids": [ids],
                    "vectors": [data],
                },
                schema=_BLOCK,
            )

        for batch in rows:
            for at in range(0, len(batch), size):
                piece = batch.slice(at, size)
                ids = piece.column("vec_id").to_numpy(zero_copy_only=False)
                column = piece.column("vector")
                offsets = column.offsets.to_numpy()
                flat = column.values.to_numpy(zero_copy_only=False)
                lengths = np.diff(offsets)
                for dim in np.unique(lengths):
                    rows_ = np.flatnonzero(lengths == dim)
                    data = flat[offsets[rows_][:, None] + np.arange(dim)]
                    waiting.setdefault(int(dim), []).append((ids[rows_], data))
                    if sum(len(x[0]) for x in waiting[int(dim)]) >= size:
                        yield block(int(dim))
        for dim in list(waiting):
            yield block(dim)

    return vectors.mapInArrow(gather, BLOCK)


class VectorApproximation:
    """Cell numbers of a block of integer vectors and bounds on inner products.

    Every dimension is cut into ``2**bits`` cells at quantiles of the block; a cell is
    known by the smallest and largest value in it. Only the cell numbers are scanned for
    bounds, two dimensions in a byte: a query turns its largest possible products into
    tables of 256 sums, one per pair, in which every byte is looked up. Bounds are
    computed in double precision with a margin for its rounding; scores are integers.
    """

    def __init__(self, vectors: np.ndarray, bits: int = CELL_BITS):
        if not 1 <= bits <= 4:
            raise ValueError(f"cells take one to four bits, not {bits}")
        self.vectors = vectors
        n, dim = vectors.shape
        cells, pairs = 1 << bits, (dim + 1) // 2
        self._low, self._high = np.zeros((2 * pairs, 16)), np.zeros((2 * pairs, 16))
        self.cells = np.zeros((pairs, n), np.uint8)
        for d in range(dim):
            column = vectors[:, d]
            edges = np.quantile(column, np.arange(1, cells) / cells, method="lower")
            cell = np.searchsorted(edges, column, side="right").astype(np.uint8)
            self.cells[d // 2] |= cell << np.uint8(4 * (d % 2))
            low, high = np.full(16, np.inf), np.full(16, -np.inf)
            np.minimum.at(low, cell, column)
            np.maximum.at(high, cell, column)
            used = low <= high
            self._low[d, used], self._high[d, used] = low[used], high[used]

    def upper_bounds(self, queries: np.ndarray) -> np.ndarray:
        """A bound from above on every (query, vector) inner product."""
        out = np.zeros((len(queries), self.cells.shape[1]))
        for query, bounds in zip(queries.astype(float), out, strict=True):
            q = np.zeros((len(self._low), 1))
            q[: len(query), 0] = query
            low, high = q * self._low, q * self._high
            most = np.maximum(low, high)
            size = np.maximum(np.abs(low), np.abs(high)).max(axis=1).sum()
            # The odd dimension of a pair is in the upper half of the byte.
            pairs = (most[1::2, :, None] + most[0::2, None, :]).reshape(-1, 256)
            for sums, byte in zip(pairs, self.cells, strict=True):
                bounds += sums[byte]
            bounds += size * 1e-12
        return out

    def search(
        self, query: np.ndarray, bounds: np.ndarray, ids: np.ndarray, own: int | None, k: int
    ) -> list[tuple[int, int]]:
        """(score, id) of the k best, by reading exact vectors in the order of their
        bounds until none of the rest can reach the k-th score, ties included."""
        order, at = _by_bound(bounds, 4 * k), 0
        best: list[tuple[int, int]] = []
        while at < len(bounds):
            if at >= len(order):
                order = np.argsort(-bounds, kind="stable")
            step = order[at : min(at + STEP, len(order))]
            if len(best) >= k and bounds[step[0]] < -best[k - 1][0]:
                break
            scores = exact_products(self.vectors[step], query)
            found = zip((-scores).tolist(), ids[step].tolist(), strict=True)
            best.extend(x for x in found if x[1] != own)
            best = sorted(best)[:k]
            at += len(step)
        return [(-score, vec_id) for score, vec_id in best]


def _by_bound(bounds: np.ndarray, n: int) -> np.ndarray:
    """Positions of the n largest bounds, largest first: most searches end among them."""
    if n >= len(bounds):
        return np.argsort(-bounds, kind="stable")
    # All that tie with the n-th are among them, so that the full order starts alike.
    least = np.partition(bounds, len(bounds) - n)[len(bounds) - n]
    first = np.flatnonzero(bounds >= least)
    return first[np.argsort(-bounds[first], kind="stable")]


def exact_products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Integer inner products; Python integers where 64 bits could overflow."""
    largest = float(np.abs(vectors).max(initial=0)) * float(np.abs(query).max(initial=0))
    if largest * len(query) < 2**62:
        return vectors @ query
    return vectors.astype(object) @ query.astype(object)


def _search_blocks(k: int, bits: int):
    def search(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in rows:
            for row in frame.itertuples(index=False):
                ids = np.frombuffer(row.ids, "<i8")
                data = VectorApproximation(np.frombuffer(row.vectors, "<i8").reshape(-1, row.dim), bits)
                query_ids = np.frombuffer(row.query_ids, "<i8")
                queries = np.frombuffer(row.queries, "<i8").reshape(-1, row.dim)
                out: list[tuple[int, int, int]] = []
                for start in range(0, len(queries), 256):
                    some = queries[start : start + 256]
                    bounds = data.upper_bounds(some)
                    for i, query in enumerate(some):
                        own = int(query_ids[start + i])
                        found = data.search(query, bounds[i], ids, own, k)
                        out.extend((own, vec_id, score) for score, vec_id in found)
                yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    return search


def top_k_products(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    bits: int = CELL_BITS,
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """The k largest integer inner products of every query: query_id, rank, vec_id, score.

    ``vectors`` and ``queries`` hold ``vec_id`` and ``vector`` (array of long). Both are
    cut into blocks of bounded size; every block of vectors meets every block of queries
    of its dimension once, which is the stated work of an exact search. A meeting scans
    the block's cells for bounds, reads exact vectors in bound order until the k-th
    score is certain, and hands on k rows per query, so little is shuffled afterwards.

    Exact always. A query never finds the row of its own id; ties go to the smaller
    ``vec_id``; with fewer than k candidates all are returned; vectors of another length
    than the query's are no candidates. Rows that repeat a ``vec_id`` count once if their
    scores agree and otherwise by the larger score. Rows with a null id take no part.
    Empty tables give no rows.
    """
    vectors, queries = (
        t.where(F.col("vec_id").isNotNull() & usable(F.col("vector"))).select(
            F.col("vec_id").cast("long"), F.col("vector").cast("array<long>").alias("vector")
        )
        for t in (vectors, queries)
    )
    asked = to_blocks(queries, query_rows).select(
        "dim",
        F.col("block").alias("query_block"),
        F.col("ids").alias("query_ids"),
        F.col("vectors").alias("queries"),
    )
    # Blocks are dealt over the tasks whichever dimension they have; tasks grow in number
    # with the blocks, not in size.
    parts = max(PARTS, math.ceil(vectors.count() / (block_rows * PART_BLOCKS)))
    asked = asked.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    met = to_blocks(vectors, block_rows, parts).join(asked, ["dim", "part"])
    found = met.select("dim", "ids", "vectors", "query_ids", "queries").mapInPandas(
        _search_blocks(k, bits), "query_id long, vec_id long, score long"
    )
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        once.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
