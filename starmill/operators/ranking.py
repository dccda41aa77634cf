"""Shares, ranks and top rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmill.functions.buckets import percentage


def share_of_total(grouped: DataFrame, count: str, share: str) -> DataFrame:
    """Add each group's share of all rows in percent.

    The total is a scalar subquery over the same shuffle: no window that would bring
    all groups into one task.
    """
    total = grouped.agg(F.sum(count)).scalar()
    return grouped.withColumn(share, percentage(F.col(count), total))


def top_k_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int, rank: str
) -> DataFrame:
    """The first ``k`` rows of every group, numbered from 1.

    ``order`` must be unique within a group. Spark trims each group to ``k`` rows per
    map task ahead of the shuffle, so a huge group reaches its reducer as few rows.
    """
    position = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn(rank, position).where(F.col(rank) <= k)


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows overall; ``order`` must be unique for a stable answer."""
    return df.orderBy(*order).limit(n)
