"""Fewer fact rows ahead of an aggregation: only those whose key a lookup may hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits for every key, hashes of a key (false positives near 1 %), and bits at most: 8 MB.
BITS_PER_KEY, HASHES, MOST_BITS = 10, 4, 1 << 26


def _places(key: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(bits)) for i in range(HASHES)]


def reduce_by_keys(
    facts: DataFrame, lookup: DataFrame, key: str, most_bits: int = MOST_BITS
) -> DataFrame:
    """Facts without most of the rows whose key the lookup lacks, and with all others.

    A Bloom filter of the lookup's keys is built once as an array of words and tested in
    the scan of the facts, so that rows that join nothing reach no shuffle. Its size
    follows the number of keys up to ``most_bits``; beyond that it lets more rows pass.
    Rows without a key go. What passes by chance is left to the join that follows.
    """
    keys = lookup.where(F.col(key).isNotNull()).select(key).distinct()
    bits = max(64, min(keys.count() * BITS_PER_KEY, most_bits) // 64 * 64)
    place = keys.select(F.explode(F.array(*_places(F.col(key), bits))).alias("place"))
    set_bits = place.groupBy(F.expr("place div 64").alias("at")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(place % 64 AS INT)))").alias("word")
    )
    empty = facts.sparkSession.range(bits // 64).select(F.col("id").alias("at"))
    words = empty.join(set_bits, "at", "left").select("at", F.coalesce("word", F.lit(0)).alias("word"))
    in_order = F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda w: w.word)
    held = words.agg(in_order).scalar()
    passes = F.col(key).isNotNull()
    for p in _places(F.col(key), bits):
        word = F.get(held, F.floor(p / 64).cast("int"))
        passes &= F.getbit(word, (p % 64).cast("int")) == 1
    return facts.where(passes)
