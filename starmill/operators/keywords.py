"""Keyword extraction and ranking."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.functions.buckets import scaled_ratio
from starmill.functions.text import ASCII_WORD, STOP_WORDS, is_keyword, word_array
from starmill.operators.ranking import top_k_per_group


def clean_tokens(
    df: DataFrame,
    text: Column,
    keep: Iterable[str],
    stop_words: Iterable[str] = STOP_WORDS,
    min_chars: int = 3,
    word_chars: str = ASCII_WORD,
    token: str = "token",
) -> DataFrame:
    """One row per keyword occurrence with the columns ``keep`` of its text."""
    words = df.select(*keep, F.explode(word_array(text, word_chars, min_chars)).alias(token))
    lowered = words.select(*keep, F.lower(token).alias(token))
    return lowered.where(is_keyword(F.col(token), stop_words))


def rank_keywords(tokens: DataFrame, group: str, token: str = "token", k: int = 40) -> DataFrame:
    """The ``k`` most frequent keywords of every group and their share per 10,000.

    Occurrences are counted map-side first. The cut to ``k`` comes ahead of the join
    with the group totals, so the join sees ``k`` rows per group instead of a
    vocabulary; ties go to the alphabetically first keyword.
    """
    counts = tokens.groupBy(group, F.col(token).alias("keyword")).agg(
        F.count("*").alias("keyword_count")
    )
    totals = counts.groupBy(group).agg(F.sum("keyword_count").alias("_total"))
    return rank_counts(counts, totals, group, k)


def rank_counts(counts: DataFrame, totals: DataFrame, group: str, k: int) -> DataFrame:
    """Ranks and shares from counts per (group, keyword) and the totals of the groups."""
    order = [F.desc("keyword_count"), F.asc("keyword")]
    top = top_k_per_group(counts, [group], order, k, "keyword_rank")
    per_10k = scaled_ratio(F.col("keyword_count"), F.col("_total"), "10000.0")
    return (
        top.join(totals, group)
        .withColumn("frequency_per_10k_words", per_10k)
        .select(
            group, "keyword_rank", "keyword", "keyword_count", "frequency_per_10k_words"
        )
        .orderBy(group, "keyword_rank")
    )
