"""Summaries kept per period and merged, instead of a new scan for every question."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmill.session import materialise

#: Size of a quantile sketch, and the rank error that it keeps with 99 % of its answers.
SKETCH_SIZE, RANK_ERROR = 400, 0.01


def quantile_sketches(df: DataFrame, groups: Sequence[str], period: str, measure: str) -> DataFrame:
    """One KLL sketch per group and period, ready to be stored and merged."""
    sketch = F.kll_sketch_agg_double(F.col(measure).cast("double"), SKETCH_SIZE)
    valued = df.where(F.col(measure).isNotNull())
    return valued.groupBy(*groups, period).agg(sketch.alias("sketch"), F.count("*").alias("n"))


def merged_quantile(sketches: DataFrame, groups: Sequence[str], rank: float = 0.5) -> DataFrame:
    """The value near ``rank`` of every group over all its periods, and its rows."""
    merged = F.kll_merge_agg_double("sketch", SKETCH_SIZE)
    value = F.kll_sketch_get_quantile_double(merged, F.lit(rank))
    return sketches.groupBy(*groups).agg(value.alias("value"), F.sum("n").alias("n"))


def rank_errors(df: DataFrame, found: DataFrame, groups: Sequence[str], measure: str, rank: float) -> DataFrame:
    """How far the ranks that a found value has lie from the wanted one; 0 if around it.

    ``found`` is one value per group, so it is joined to whole groups of rows only for
    a check.
    """
    joined = df.where(F.col(measure).isNotNull()).join(found.select(*groups, "value"), list(groups))
    below = F.count_if(F.col(measure) < F.col("value")) / F.count("*")
    upto = F.count_if(F.col(measure) <= F.col("value")) / F.count("*")
    error = F.greatest(below - rank, rank - upto, F.lit(0.0))
    return joined.groupBy(*groups).agg(F.count("*").alias("n"), error.alias("rank_error"))


def dense_ids(df: DataFrame, key: str) -> DataFrame:
    """(key, dense_id): whole numbers from 0 without gaps, in the order of the keys.

    Keys are cut into ranges; the number of keys before a range, one row for each, is
    added to the place within it. No task holds more than a range.
    """
    keys = df.where(F.col(key).isNotNull()).select(key).distinct()
    ranges = keys.repartitionByRange(key).withColumn("_range", F.spark_partition_id())
    ranges = materialise(ranges, "key-ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranges.groupBy("_range").agg(F.count("*").alias("_n"))
    starts = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(key)) - 1
    placed = ranges.select(key, "_range", place.alias("_place")).join(F.broadcast(starts), "_range")
    return placed.select(key, (F.col("_start") + F.col("_place")).alias("dense_id"))


def distinct_bitmaps(df: DataFrame, ids: DataFrame, groups: Sequence[str], period: str, key: str) -> DataFrame:
    """One bitmap per group, period and 32,768 dense ids: exact, and mergeable by OR.

    Rows first become distinct keys, map-side, so a key with very many rows is one.
    """
    seen = df.where(F.col(key).isNotNull()).select(*groups, period, key).distinct().join(ids, key)
    bucket = F.bitmap_bucket_number("dense_id").alias("bucket")
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("dense_id")).alias("bits")
    return seen.groupBy(*groups, period, bucket).agg(bits)


def distinct_from(bitmaps: DataFrame, groups: Sequence[str], name: str) -> DataFrame:
    """Distinct keys of every group over all stored periods."""
    merged = bitmaps.groupBy(*groups, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy(*groups).agg(F.sum(F.bitmap_count("bits")).alias(name))
