"""One row per key, the same row on every run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dedup_by_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep one row of every key: that with the smallest digest of its texts, then the
    smallest by all other columns in order. The digest keeps the survivor from being the
    one with the lowest score, and sorts compare it ahead of long texts.

    The order is total up to identical rows, so any partitioning keeps the same row.
    Spark limits each key to one row per map task ahead of the shuffle, which keeps a
    heavily copied key small when it reaches its reducer. Null keys count as equal.
    """
    others = [F.col(c).asc_nulls_last() for c in df.columns if c not in keys]
    texts = [c for c, kind in df.dtypes if kind == "string" and c not in keys]
    digest = F.md5(F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in texts]))
    order = ([digest.asc()] if texts else []) + (others or list(keys))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")
