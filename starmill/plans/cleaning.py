"""Raw reviews and products to clean, deduplicated tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmill.functions.parsing import clean_label, parse_count, parse_price, utc_date
from starmill.functions.text import text_length
from starmill.operators.dedup import dedup_by_key
from starmill.operators.profile import WriteCounts, clean_counts
from starmill.sources.readers import read_table
from starmill.sources.writers import write_table

REVIEW_KEY = ["reviewerID", "asin", "unix_time"]
PRODUCT_KEY = ["asin"]


def _finite(value: Column) -> Column:
    """Null instead of NaN and infinities, which would enter every mean."""
    return F.when(F.abs(value) < float("inf"), value)


def _typed_reviews(raw: DataFrame) -> DataFrame:
    return raw.select(
        "reviewerID",
        "asin",
        _finite(F.col("overall").try_cast("double")).alias("rating"),
        F.col("verified").try_cast("boolean").alias("verified"),
        "reviewText",
        "summary",
        F.col("unixReviewTime").try_cast("bigint").alias("unix_time"),
        parse_count(F.col("vote")).alias("helpful_votes"),
    )


def _valid_raw() -> Column:
    score = F.col("overall").try_cast("double")
    known = F.col("reviewerID").isNotNull() & F.col("asin").isNotNull()
    return known & _finite(score).isNotNull()


def _valid_review() -> Column:
    return (
        F.col("reviewerID").isNotNull() & F.col("asin").isNotNull() & F.col("rating").isNotNull()
    )


def clean_reviews(raw: DataFrame) -> DataFrame:
    """Typed reviews with reviewer, item and rating, one per (reviewer, item, time).

    Deduplication comes ahead of the derived columns: they follow from the others, so
    the shuffle need not carry them.
    """
    kept = dedup_by_key(_typed_reviews(raw).where(_valid_review()), REVIEW_KEY)
    day = utc_date(F.col("unix_time"))
    length = text_length(F.col("reviewText"))
    return kept.select(
        "*",
        day.alias("review_date"),
        F.year(day).alias("review_year"),
        F.month(day).alias("review_month"),
        length.alias("review_length"),
        F.when(length > 0, 1).otherwise(0).alias("has_review_text"),
    )


def clean_products(raw: DataFrame, legacy: bool = False) -> DataFrame:
    """Products with a readable brand and a numeric price, one per item.

    ``legacy`` reproduces the parsing behind the published tables: prices stop at a
    thousands comma and "by " is removed anywhere in a brand.
    """
    columns = ["asin", "title", "brand", "price", "also_buy", "also_view"]
    kept = dedup_by_key(raw.select(*columns).where(F.col("asin").isNotNull()), PRODUCT_KEY)
    return kept.select(
        "asin",
        "title",
        F.col("price").alias("price_raw"),
        "also_buy",
        "also_view",
        clean_label(F.col("brand"), legacy).alias("brand"),
        parse_price(F.col("price"), legacy).alias("price"),
    )


def write_clean_reviews(spark: SparkSession, raw_path: str, path: str) -> DataFrame:
    """Landed reviews cleaned into ``path`` in one scan; returns what was counted."""
    counting = WriteCounts(read_table(spark.newSession(), raw_path), _valid_raw())
    write_table(clean_reviews(counting.watched), path)
    return counting.counts(read_table(counting.watched.sparkSession, path))


def write_clean_products(
    spark: SparkSession, raw_path: str, path: str, legacy: bool = False
) -> DataFrame:
    """Landed products cleaned into ``path`` in one scan; returns what was counted."""
    counting = WriteCounts(read_table(spark.newSession(), raw_path), F.col("asin").isNotNull())
    write_table(clean_products(counting.watched, legacy), path)
    return counting.counts(read_table(counting.watched.sparkSession, path))


def review_counts(raw: DataFrame, cleaned: DataFrame | None = None) -> DataFrame:
    """How many raw reviews were corrupt, rejected, merged and kept. Without the written
    clean table its distinct keys are counted."""
    typed = _typed_reviews(raw)
    if cleaned is None:
        cleaned = typed.where(_valid_review()).select(*REVIEW_KEY).distinct()
    return clean_counts(raw, _valid_raw(), cleaned)


def product_counts(raw: DataFrame, cleaned: DataFrame | None = None) -> DataFrame:
    """How many raw products were corrupt, rejected, merged and kept."""
    if cleaned is None:
        cleaned = raw.where(F.col("asin").isNotNull()).select(*PRODUCT_KEY).distinct()
    return clean_counts(raw, F.col("asin").isNotNull(), cleaned)
