"""Parquet tables and report files."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.storagelevel import StorageLevel


@contextmanager
def persisted(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a DataFrame for several consumers and always let go of it again."""
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_report(
    df: DataFrame, csv_path: str, table_path: str | None = None, one_file: bool = False
) -> None:
    """A result as CSV with header, and as Parquet too if asked, computed once.

    ``one_file`` is for results that their definition bounds, such as a ranking's first
    rows; anything else is written in parallel.
    """
    with persisted(df) as result:
        out = result.coalesce(1) if one_file else result
        out.write.mode("overwrite").option("header", True).csv(csv_path)
        if table_path is not None:
            out.write.mode("overwrite").parquet(table_path)
