"""Fact and lookup tables that lie side by side, so that later jobs move no whole rows.

Both are bucketed by the lookup key and a part number. A key that holds much of the facts
has its rows dealt over several parts by the rest of their row key, and its lookup row
copied to each; every other key has part 0. Equal row keys therefore share a bucket, and
deduplication, inner and left joins read the buckets as they lie.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.operators.dedup import dedup_by_key
from starmill.operators.joins import HOT_PARTS, HOT_ROWS, SALTS
from starmill.session import materialise, shared_dir

#: Column that tells the parts of a hot key apart.
PART = "bucket_part"
_ROWS, _HOT, _COPIED = "_bucket_rows", "_bucket_hot", "_bucket_copied"


@dataclass(frozen=True)
class BucketLayout:
    """How the rows of some facts are dealt: shared by every table laid beside them.

    ``hot`` holds the hot lookup keys and ``copied`` the row keys with many copies, both
    fewer than the share that makes them so allows. They belong to the layout: rows that
    arrive later are dealt by the same lists, so that copies of a row still meet.
    """

    key: str
    row_key: tuple[str, ...]
    buckets: int
    hot: DataFrame
    copied: DataFrame


def plan_buckets(
    facts: DataFrame,
    key: str,
    row_key: Sequence[str],
    buckets: int | None = None,
    parts: int = HOT_PARTS,
    min_rows: int = HOT_ROWS,
) -> BucketLayout:
    """The layout for facts with a lookup key and the columns that tell rows apart.

    One pass over the key columns counts copies; the lists of what holds more than
    ``1/parts`` of the rows and ``min_rows`` of them are written to the shared folder.
    ``buckets`` should make one bucket's rows fit a task; by default it is the number of
    shuffle partitions.
    """
    if key not in row_key:
        raise ValueError(f"{key} must be one of the columns that tell rows apart: {list(row_key)}")
    copies = facts.groupBy(*row_key).agg(F.count("*").alias(_ROWS))
    rows = copies.agg(F.sum(_ROWS)).scalar()
    many = (F.col(_ROWS).cast("double") * parts > rows) & (F.col(_ROWS) >= min_rows)
    sizes = copies.where(F.col(key).isNotNull()).groupBy(key).agg(F.sum(_ROWS).alias(_ROWS))
    spark = facts.sparkSession
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return BucketLayout(
        key,
        tuple(row_key),
        count,
        materialise(sizes.where(many).select(key), "hot-keys"),
        materialise(copies.where(many).select(*row_key), "copied-keys"),
    )


def land_facts(
    facts: DataFrame, layout: BucketLayout, partition_by: Sequence[str] = (), name: str | None = None
) -> DataFrame:
    """Write facts once by bucket, one file per bucket and value of ``partition_by``.

    The one shuffle of whole rows. Row keys with very many copies are cut to the copy
    that ``dedup_by_key`` keeps, map-side, since all their copies would meet in one
    bucket; all other copies are kept. Rows without the lookup key are dealt over parts.
    """
    marked = facts.join(F.broadcast(layout.copied.withColumn(_COPIED, F.lit(True))), _null_safe(facts, layout.copied, layout.row_key), "left")
    marked = marked.select(*[facts[c] for c in facts.columns], F.col(_COPIED))
    few = marked.where(F.col(_COPIED).isNull()).drop(_COPIED)
    one = dedup_by_key(marked.where(_COPIED).drop(_COPIED), layout.row_key)
    rows = few.unionByName(one)
    hot = F.broadcast(layout.hot.withColumn(_HOT, F.lit(True)))
    dealt = rows.join(hot, layout.key, "left").select(
        *rows.columns, F.when(F.col(_HOT) | F.col(layout.key).isNull(), _part(layout)).otherwise(0).alias(PART)
    )
    return _write(dealt, layout, partition_by, name)


def land_lookup(lookup: DataFrame, layout: BucketLayout, name: str | None = None) -> DataFrame:
    """Write a lookup table beside the facts, with a copy per part for hot keys."""
    hot = F.broadcast(layout.hot.withColumn(_HOT, F.lit(True)))
    parts = F.when(F.col(_HOT), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    copied = lookup.join(hot, layout.key, "left").select(*lookup.columns, F.explode(parts).alias(PART))
    return _write(copied, layout, (), name)


def dedup_landed(facts: DataFrame, layout: BucketLayout) -> DataFrame:
    """One row per row key of landed facts, where they lie.

    A row's part follows from its row key, so ranking by both keeps the same row.
    """
    return dedup_by_key(facts, [*layout.row_key, PART]).drop(PART)


def join_landed(
    facts: DataFrame, lookup: DataFrame, layout: BucketLayout, how: str = "inner"
) -> DataFrame:
    """Landed facts with the columns of the lookup landed beside them, bucket by bucket."""
    if how not in ("inner", "left"):
        raise ValueError(f"lookups are inner or left joins, not {how}")
    return facts.join(lookup.hint("merge"), [layout.key, PART], how).drop(PART)


def _null_safe(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    condition = F.lit(True)
    for c in columns:
        condition &= left[c].eqNullSafe(right[c])
    return condition


def _part(layout: BucketLayout) -> Column:
    rest = [c for c in layout.row_key if c != layout.key]
    return F.pmod(F.xxhash64(*rest), F.lit(SALTS)).cast("int") if rest else F.lit(0)


def _write(
    df: DataFrame, layout: BucketLayout, partition_by: Sequence[str], name: str | None
) -> DataFrame:
    """As many tasks as buckets, each with the rows of one: no bucket has two files."""
    spark: SparkSession = df.sparkSession
    name = name or f"landed_{uuid.uuid4().hex}"
    by = (layout.key, PART)
    writer = df.repartition(layout.buckets, *by).write.format("parquet")
    writer = writer.bucketBy(layout.buckets, *by).sortBy(*by)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.option("path", f"{shared_dir(spark)}/{name}").saveAsTable(name)
    return spark.table(name).select(*df.columns)
