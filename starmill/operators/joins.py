"""Lookups whose fact side may be dominated by a few keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key with more than 1/HOT_PARTS of the rows, and at least HOT_ROWS of them, is hot:
# fewer than HOT_PARTS keys, whose list is what gets broadcast.
HOT_PARTS = 10_000
HOT_ROWS = 100_000

# Parts that the rows of a hot key are dealt over, and copies of its lookup row.
SALTS = 64


def hot_keys(
    facts: DataFrame, key: str, parts: int = HOT_PARTS, min_rows: int = HOT_ROWS
) -> DataFrame:
    """Keys holding more than ``1/parts`` of the rows and ``min_rows``: fewer than ``parts``."""
    return _hot(_sizes(facts, key), key, parts, min_rows)


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    how: str = "inner",
    parts: int = HOT_PARTS,
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """``facts`` with the columns of ``lookup``, which may itself be an aggregate.

    One pass over the key column finds the hot keys, one over the facts joins them:
    rows of a hot key, and rows without a key in a left join, are dealt over SALTS parts
    by their content, and the lookup rows of hot keys are copied to all of them. Every
    other key stays whole. Building the join starts no job, and whether a side is small
    enough to be broadcast is Spark's to decide from sizes that it measures. A lookup
    that repeats a key repeats the facts, as any join does.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"lookups are inner or left joins, not {how}")
    return _salted_join(facts, lookup, key, how, hot_keys(facts, key, parts, min_rows))


def with_group_size(
    facts: DataFrame, key: str, size: str, parts: int = HOT_PARTS, min_rows: int = HOT_ROWS
) -> DataFrame:
    """Every row with the number of rows that share its key; null keys are dropped.

    Sizes and hot keys come from one shuffle of partial counts.
    """
    sizes = _sizes(facts, key, size)
    return _salted_join(facts, sizes, key, "inner", _hot(sizes, key, parts, min_rows, size))


def _sizes(facts: DataFrame, key: str, size: str = "_size") -> DataFrame:
    return facts.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias(size))


def _hot(sizes: DataFrame, key: str, parts: int, min_rows: int, size: str = "_size") -> DataFrame:
    rows = sizes.agg(F.sum(size)).scalar()
    many = (F.col(size).cast("double") * parts > rows) & (F.col(size) >= min_rows)
    return sizes.where(many).select(key)


def _salted_join(
    facts: DataFrame, lookup: DataFrame, key: str, how: str, hot: DataFrame
) -> DataFrame:
    hot = F.broadcast(hot.withColumn("_hot", F.lit(True)))
    salt = F.pmod(F.xxhash64(*facts.columns), F.lit(SALTS))
    spread = F.col("_hot") | F.col(key).isNull()
    dealt = facts.join(hot, key, "left").withColumn("_salt", _when(spread, salt, F.lit(0)))
    zero = F.lit(0).cast("bigint")
    copies = F.sequence(zero, F.lit(SALTS - 1).cast("bigint"))
    copied = lookup.join(hot, key, "left").withColumn(
        "_salt", F.explode(_when(F.col("_hot"), copies, F.array(zero)))
    )
    return dealt.drop("_hot").join(copied.drop("_hot"), [key, "_salt"], how).drop("_salt")


def _when(condition: Column, then: Column, otherwise: Column) -> Column:
    return F.when(condition, then).otherwise(otherwise)
