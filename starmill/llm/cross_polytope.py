"""Approximate nearest neighbours by inner product with cross-polytope hashing."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmill.llm.common import mix64, stored
from starmill.llm.vector_topk import usable

#: Rows of a bucket that meet in one task; larger buckets are dealt over several.
BUCKET_ROWS = 4096
ROTATIONS = 3
#: Vectors that a query should meet in every table and norm band; it looks into all
#: buckets of bands with fewer.
LEAST_MET = 128


def hadamard(rows: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of every row, orthonormal; a power of two wide."""
    width, half = rows.shape[1], 1
    while half < width:
        pairs = rows.reshape(len(rows), -1, 2, half)
        rows = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2)
        rows = rows.reshape(len(rows), width)
        half *= 2
    return rows / np.sqrt(width)


def signs(table: int, turn: int, width: int, seed: int) -> np.ndarray:
    """Pseudo-random signs of one turn of one table, the same on every machine."""
    bits = mix64(np.arange(width), seed * 1_000_003 + table * 101 + turn + 1)
    return np.where(bits >> np.uint64(63), -1.0, 1.0)


def rotated(rows: np.ndarray, table: int, seed: int) -> np.ndarray:
    """Rows after three sign flips, each followed by a Hadamard transform."""
    for turn in range(ROTATIONS):
        rows = hadamard(rows * signs(table, turn, rows.shape[1], seed))
    return rows


def nearest_axis(rows: np.ndarray) -> np.ndarray:
    """Number of the nearest signed axis: twice the axis, plus one if negative."""
    axis = np.argmax(np.abs(rows), axis=1)
    return axis * 2 + (rows[np.arange(len(rows)), axis] < 0)


def nearest_axes(rows: np.ndarray, probes: int) -> np.ndarray:
    """Numbers of the ``probes`` nearest signed axes of every row."""
    values = np.empty((len(rows), rows.shape[1] * 2))
    values[:, 0::2], values[:, 1::2] = rows, -rows
    probes = min(probes, values.shape[1])
    return np.argpartition(-values, probes - 1, axis=1)[:, :probes]


@dataclass(frozen=True)
class Hashing:
    """Shape of the index: within a norm band, inner products order much like angles.

    ``probe_share`` is the share of a table's buckets that a query looks into, ``sizes``
    holds the number of vectors of every (length, norm band). A band that a query looks
    into as a whole needs one table only.
    """

    tables: int
    probe_share: float
    seed: int
    sizes: dict[tuple[int, int], int]

    def probes(self, dim: int, band: int) -> int | None:
        """Buckets of a table that a query looks into, None for all of them."""
        n, buckets = self.sizes[dim, band], 2 * _width(dim)
        wanted = max(1, round(buckets * max(self.probe_share, LEAST_MET / n)))
        return wanted if wanted < buckets else None


def _width(dim: int) -> int:
    return 1 << max(1, (dim - 1).bit_length())


def directions(rows: np.ndarray) -> np.ndarray:
    """Unit vectors, padded to a power of two."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # squares stay in range
    out = np.zeros((len(rows), _width(rows.shape[1])))
    out[:, : rows.shape[1]] = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    return out


KEY = ["dim", "band", "bucket"]
BUCKETED = "dim int, band int, bucket int, vec_id long, vector binary"
_ARROW = pa.schema(
    [
        ("dim", pa.int32()),
        ("band", pa.int32()),
        ("bucket", pa.int32()),
        ("vec_id", pa.int64()),
        ("vector", pa.binary()),
    ]
)


def _bucketed(vectors: DataFrame, hashing: Hashing, probing: bool) -> DataFrame:
    """A row for every bucket that a vector lies in, or that a query looks into."""
    bands: dict[int, list[int]] = {}
    for dim, band in hashing.sizes:
        bands.setdefault(dim, []).append(band)

    def rows_of(dim, band, number, ids, packed) -> pa.RecordBatch:
        repeat = np.repeat(np.arange(len(ids)), number.shape[1])
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(repeat), dim, np.int32)),
                pa.array(np.full(len(repeat), band, np.int32)),
                pa.array(number.ravel().astype(np.int32)),
                pa.array(ids[repeat]),
                pa.array([packed[i] for i in repeat], pa.binary()),
            ],
            schema=_ARROW,
        )

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
            band_of = batch.column("band").to_numpy(zero_copy_only=False)
            column = batch.column("vector")
            offsets = column.offsets.to_numpy()
            flat = column.values.to_numpy(zero_copy_only=False)
            lengths = np.diff(offsets)
            for dim in np.unique(lengths):
                rows = np.flatnonzero(lengths == dim)
                data = flat[offsets[rows][:, None] + np.arange(dim)]
                packed = [row.tobytes() for row in data.astype("<f8")]
                unit = directions(data)
                buckets = 2 * unit.shape[1]
                for table in range(hashing.tables):
                    turned = rotated(unit, table, hashing.seed)
                    for band in bands.get(int(dim), []):
                        probes = hashing.probes(int(dim), band)
                        if probes is None and table:
                            continue
                        if not probing:
                            own = np.flatnonzero(band_of[rows] == band)
                            axes = nearest_axis(turned[own])[:, None]
                        else:
                            own = np.arange(len(rows))
                            axes = nearest_axes(turned, probes or buckets)
                        if len(own):
                            number = table * buckets + axes
                            yield rows_of(dim, band, number, ids[rows[own]], [packed[i] for i in own])

    return vectors.mapInArrow(assign, BUCKETED)


def _rerank(k: int):
    def rerank(key: tuple, asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        """Exact products of a bucket's queries with its vectors, the k best of each."""
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        if asked.empty or held.empty:
            return empty
        dim = key[0]
        held = held.sort_values("vec_id")
        ids = held["vec_id"].to_numpy()
        data = np.frombuffer(b"".join(held["vector"]), "<f8").reshape(-1, dim)
        query_ids = asked["vec_id"].to_numpy()
        queries = np.frombuffer(b"".join(asked["vector"]), "<f8").reshape(-1, dim)
        out = []
        for start in range(0, len(queries), 512):
            some = query_ids[start : start + 512]
            scores = queries[start : start + 512] @ data.T
            scores[some[:, None] == ids] = -np.inf
            for query_id, row in zip(some, scores, strict=True):
                best = _best(row, k)
                out.append((np.full(len(best), query_id), ids[best], row[best]))
        parts = [np.concatenate(x) for x in zip(*out, strict=True)]
        return pd.DataFrame(dict(zip(empty.columns, parts, strict=True)))

    return rerank


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k largest scores, ties to the earlier; own rows are left out."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        found = np.flatnonzero(scores >= least)
        found = found[np.argsort(-scores[found], kind="stable")][:k]
    else:
        found = np.argsort(-scores, kind="stable")
    return found[scores[found] > -np.inf]


def nearest_products(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    tables: int = 8,
    probe_share: float = 0.125,
    seed: int = 7,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """The k largest inner products found for every query: query_id, rank, vec_id, score.

    ``vectors`` and ``queries`` hold ``vec_id`` and ``vector``. Vectors whose norms lie
    within half a power of two are a band with an index of its own, so that long vectors
    hide no short ones and no other way round. A vector lies in one bucket per table,
    that of the signed axis nearest to its direction after a pseudo-random rotation; a
    query looks into the buckets of its ``probe_share`` nearest axes in every table of
    every band, and all vectors there are ranked by their exact product in double
    precision. Bands of few vectors are looked through whole (``LEAST_MET``), and so is
    the table by queries that were left with fewer than k neighbours. A bucket of many
    vectors or queries is dealt over several tasks in blocks of about ``bucket_rows``,
    all of which are met.

    Which neighbours are found depends on the tables and probes; scores are exact and
    ties go to the smaller ``vec_id``. A query never finds its own id, and finds fewer
    than k only where there are no more. Vectors that are null, zero or hold null or
    non-finite components take no part, nor do rows without an id or vectors of another
    length than the query's. Rows that repeat an id count once, by the larger score.
    Empty tables give no rows.
    """
    vectors, queries = (_valid(t) for t in (vectors, queries))
    # One number per length and band, of which doubles have some 4,200.
    counts = vectors.groupBy(F.size("vector").alias("dim"), "band").count().collect()
    sizes = {(r["dim"], r["band"]): r["count"] for r in counts}
    hashing = Hashing(tables, probe_share, seed, sizes)
    found = _met(vectors, queries, hashing, k, bucket_rows)
    partly = sorted({dim for dim, band in sizes if hashing.probes(dim, band) is not None})
    if partly:
        found = stored(found, "approximate-neighbours")
        enough = found.groupBy("query_id").count().where(F.col("count") >= k)
        short = queries.where(F.size("vector").isin(partly)).join(
            enough, queries["vec_id"] == enough["query_id"], "left_anti"
        )
        if not short.isEmpty():
            whole = Hashing(1, 1.0, seed, sizes)
            found = found.unionByName(_met(vectors, short, whole, k, bucket_rows))
            found = _first(found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")), k)
    return found


def _met(
    vectors: DataFrame, queries: DataFrame, hashing: Hashing, k: int, bucket_rows: int
) -> DataFrame:
    """The k best of what every query meets in the buckets that it looks into."""
    held, asked = _bucketed(vectors, hashing, False), _bucketed(queries, hashing, True)
    held, asked = _dealt(held, asked, bucket_rows)
    key = [*KEY, "held_part", "asked_part"]
    found = (
        asked.groupBy(*key)
        .cogroup(held.groupBy(*key))
        .applyInPandas(_rerank(k), "query_id long, vec_id long, score double")
    )
    return _first(found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")), k)


def _first(once: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        once.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def _valid(table: DataFrame) -> DataFrame:
    """Usable rows with the band of their norm, in half powers of two."""
    vector = F.col("vector").cast("array<double>")
    largest = F.array_max(F.transform("vector", lambda x: F.abs(x)))
    squares = F.aggregate("vector", F.lit(0.0), lambda s, x: s + (x / largest) * (x / largest))
    band = F.floor(2 * F.log2(largest) + F.log2(squares) + 0.5).cast("int")
    return (
        table.where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
        .select(F.col("vec_id").cast("long"), vector.alias("vector"))
        .where(F.exists("vector", lambda x: x != 0))
        .withColumn("band", band)
    )


def _dealt(held: DataFrame, asked: DataFrame, rows: int) -> tuple[DataFrame, DataFrame]:
    """Give both sides block numbers, so that every pair of blocks of a bucket meets.

    The sizes come to one row per bucket of a band and dimension: twice the width times
    the tables, however many vectors there are, which is what makes the broadcast small.
    """
    sizes = None
    for side, name in ((held, "held"), (asked, "asked")):
        parts = F.ceil(F.count("*") / F.lit(rows)).cast("int")
        own = side.groupBy(*KEY).agg(parts.alias(f"{name}_parts"))
        sizes = own if sizes is None else sizes.join(own, KEY)
    sizes = F.broadcast(sizes)

    def block(name: str):
        return F.pmod(F.xxhash64("vec_id"), F.col(f"{name}_parts")).cast("int")

    def every(name: str):
        return F.explode(F.sequence(F.lit(0), F.col(f"{name}_parts") - 1))

    columns = [*KEY, "held_part", "asked_part", "vec_id", "vector"]
    held = held.join(sizes, KEY).withColumn("held_part", block("held"))
    asked = asked.join(sizes, KEY).withColumn("asked_part", block("asked"))
    return (
        held.withColumn("asked_part", every("asked")).select(*columns),
        asked.withColumn("held_part", every("held")).select(*columns),
    )
