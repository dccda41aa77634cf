"""Chart-ready tables made from finished reports; drawing them is left to the reader."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.functions.buckets import LENGTH_LABELS
from starmill.functions.text import short_label, title_label
from starmill.operators.ranking import top_n

CHART_BRANDS = 15
CHART_KEYWORDS = 15


def yearly_series(trend: DataFrame) -> DataFrame:
    return trend.select("review_year", "review_count").orderBy("review_year")


def rating_bars(distribution: DataFrame) -> DataFrame:
    return distribution.select("rating", "review_count").orderBy("rating")


def verified_bars(comparison: DataFrame) -> DataFrame:
    label = title_label(F.col("purchase_type")).alias("purchase_label")
    return comparison.select(label, "avg_rating").orderBy(F.desc("purchase_label"))


def length_bucket_order(votes: DataFrame) -> DataFrame:
    """The buckets that occur, in order: the column order of the heat map."""
    return (
        votes.select("review_length_bucket_order", "review_length_bucket")
        .distinct()
        .orderBy("review_length_bucket_order")
    )


def votes_heat_map(votes: DataFrame, buckets: Sequence[str] = LENGTH_LABELS) -> DataFrame:
    """Mean votes with one row per score and one column per length bucket, in order."""
    return (
        votes.groupBy("rating")
        .pivot("review_length_bucket", list(buckets))
        .agg(F.avg("avg_helpful_votes"))
        .orderBy("rating")
    )


def user_group_bars(users: DataFrame) -> DataFrame:
    label = title_label(F.col("user_group")).alias("user_group_label")
    return users.select(label, "avg_rating", "positive_review_pct").orderBy("user_group_label")


def price_bars(prices: DataFrame) -> DataFrame:
    return prices.select(
        "price_bucket_order", "price_bucket", "review_count", "avg_rating"
    ).orderBy("price_bucket_order")


def brand_bars(brands: DataFrame, n: int = CHART_BRANDS) -> DataFrame:
    order = [F.desc("review_count"), F.desc("avg_rating"), F.asc("brand")]
    label = short_label(F.col("brand")).alias("brand_label")
    return top_n(brands, order, n).select(label, "review_count", "avg_rating")


def keyword_bars(keywords: DataFrame, k: int = CHART_KEYWORDS) -> DataFrame:
    """The first keywords of each group, the longest bar last."""
    return (
        keywords.where(F.col("keyword_rank") <= k)
        .select(
            title_label(F.col("sentiment_group")).alias("sentiment_label"),
            "keyword_rank",
            "keyword",
            "keyword_count",
        )
        .orderBy("sentiment_label", "keyword_count", F.desc("keyword_rank"))
    )


def keyword_weights(keywords: DataFrame) -> DataFrame:
    """Keyword to count per group. The input is a ranking, so a map has ``k`` entries."""
    entry = F.struct("keyword", "keyword_count")
    return keywords.groupBy("sentiment_group").agg(
        F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("keyword_counts")
    )
