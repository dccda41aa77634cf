"""Helpers shared by the text and vector operators."""

from __future__ import annotations

import ctypes
import functools
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from starmill.session import shared_dir

Step = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]

#: Rows of a result batch that a Python task hands back to Spark at once.
OUT_ROWS = 4096


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python this package, once per application, for sessions that
    were started where it is not installed."""
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        root = Path(__file__).resolve().parents[2]
        folder = tempfile.mkdtemp(prefix="starmill-package-")
        spark.sparkContext.addPyFile(
            shutil.make_archive(f"{folder}/starmill", "zip", root, "starmill")
        )
        _shipped.add(application)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Several later jobs read these rows; a lost executor then costs a re-read of files.
    """
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text modulo ``parts``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def utf8(column: str = "text") -> Column:
    """Text as its UTF-8 bytes, null as empty."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))


def words_of(text: bytes) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case, other bytes untouched."""
    return text.lower().split()


def mix64(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective mixing of 64-bit values (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        z = values.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15) % 2**64)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def release_memory() -> None:
    """Give the memory that a finished task has freed back to the machine.

    Spark reuses its Python workers for the tasks of later stages; what a worker's
    allocators keep would add up beside the executor's heap.
    """
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def releasing(step: Step) -> Step:
    """A step over record batches that releases its memory when it ends, and ahead of it
    what other functions of the same worker have left."""

    @functools.wraps(step)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        try:
            yield from step(batches)
        finally:
            release_memory()

    return run


def releasing_group(step: Callable, inputs: int = 1) -> Callable:
    """A step over the frames of one group that releases its memory when it is done.

    Spark reads off the number of arguments whether a step takes the key.
    """

    def run(key: tuple, *frames: pd.DataFrame) -> pd.DataFrame:
        try:
            return step(key, *frames)
        finally:
            release_memory()

    if inputs == 1:
        return lambda key, frame: run(key, frame)
    return lambda key, left, right: run(key, left, right)


class Carried:
    """Columns that pass through a Python stage unseen, whatever their names."""

    def __init__(self, df: DataFrame, names: list[str]):
        self.names = list(names)
        self._fields = [
            StructField(f"carried_{i}", df.schema[c].dataType) for i, c in enumerate(names)
        ]

    @property
    def columns(self) -> list[Column]:
        return [F.col(f"`{c}`").alias(f.name) for c, f in zip(self.names, self._fields)]

    def schema(self, own: str) -> StructType:
        return StructType([*StructType.fromDDL(own).fields, *self._fields])

    def of(self, batch: pa.RecordBatch) -> dict[str, pa.Array]:
        return {f.name: batch.column(f.name) for f in self._fields}

    def renamed(self, df: DataFrame, own: list[str]) -> DataFrame:
        return df.toDF(*own, *self.names)


def batches(rows: Iterator[tuple], schema: pa.Schema, size: int = OUT_ROWS) -> Iterator[pa.RecordBatch]:
    """Record batches of at most ``size`` rows made of tuples in the order of ``schema``."""
    kept: list[tuple] = []
    for row in rows:
        kept.append(row)
        if len(kept) >= size:
            yield _batch(kept, schema)
            kept = []
    if kept:
        yield _batch(kept, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )
