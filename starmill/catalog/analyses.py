"""The published reports over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from starmill.catalog.bindings import (
    DOCUMENT_REVIEWS,
    LINE_REVIEWS,
    ORDER_REVIEWS,
    PART_PRICE_EDGES,
    PART_PRICE_LABELS,
    PART_PRODUCTS,
    document_reviews,
    line_reviews,
    order_reviews,
    part_products,
)
from starmill.catalog.cleaning import CLEAN_REVIEWS
from starmill.catalog.bindings import raw_reviews, table
from starmill.catalog.registry import query
from starmill.catalog.scalars import bucket_sql, quoted
from starmill.functions.buckets import LENGTH_EDGES, LENGTH_LABELS
from starmill.operators.moments import Moments, centred
from starmill.plans.cleaning import clean_reviews
from starmill.catalog.text import cleaned, ranked
from starmill.plans import analyses

YEARLY_TREND = f"""
    SELECT review_year, COUNT(*) AS review_count, ROUND(AVG(rating), 3) AS avg_rating,
           CAST(COUNT(*) FILTER (WHERE verified) AS BIGINT) AS verified_review_count
    FROM ({LINE_REVIEWS}) WHERE review_year IS NOT NULL GROUP BY review_year
"""


@query("yearly_trend", YEARLY_TREND)
def yearly_trend(spark, sf_dir):
    return analyses.yearly_trend(line_reviews(spark, sf_dir))


RATING_DISTRIBUTION = f"""
    SELECT rating, COUNT(*) AS review_count,
           ROUND(COUNT(*) * 100.0 / SUM(COUNT(*)) OVER (), 2) AS review_pct
    FROM ({LINE_REVIEWS}) WHERE rating IS NOT NULL GROUP BY rating
"""


@query("rating_distribution", RATING_DISTRIBUTION)
def rating_distribution(spark, sf_dir):
    return analyses.rating_distribution(line_reviews(spark, sf_dir))


VERIFIED_COMPARE = f"""
    SELECT CASE WHEN verified THEN 'verified_purchase' ELSE 'non_verified_purchase' END
               AS purchase_type,
           COUNT(*) AS review_count, ROUND(AVG(rating), 3) AS avg_rating,
           ROUND(STDDEV_SAMP(rating), 3) AS rating_stddev,
           ROUND(AVG(helpful_votes), 3) AS avg_helpful_votes,
           ROUND(AVG(review_length), 1) AS avg_review_length
    FROM ({LINE_REVIEWS}) WHERE verified IS NOT NULL GROUP BY verified
"""


@query("verified_compare", VERIFIED_COMPARE)
def verified_compare(spark, sf_dir):
    return analyses.verified_compare(line_reviews(spark, sf_dir))


def votes_sql(reviews: str) -> str:
    numbers = range(1, len(LENGTH_LABELS) + 1)
    return f"""
    WITH usable AS (
        SELECT TRY_CAST(rating AS INTEGER) AS rating, helpful_votes, review_length,
               {bucket_sql("review_length", (LENGTH_EDGES, numbers))} AS bucket,
               {bucket_sql("review_length", (LENGTH_EDGES, quoted(LENGTH_LABELS)))} AS label
        FROM ({reviews})
        WHERE TRY_CAST(rating AS INTEGER) IS NOT NULL AND helpful_votes IS NOT NULL
          AND review_length IS NOT NULL)
    SELECT rating, CAST(bucket AS INTEGER) AS review_length_bucket_order,
           label AS review_length_bucket,
           COUNT(*) AS review_count, ROUND(AVG(helpful_votes), 3) AS avg_helpful_votes,
           quantile_disc(helpful_votes, 0.5) AS median_helpful_votes,
           ROUND(AVG(review_length), 1) AS avg_review_length
    FROM usable GROUP BY rating, bucket, label
    """


VOTES_BY_LENGTH = votes_sql(LINE_REVIEWS)


@query("votes_by_length", VOTES_BY_LENGTH)
def votes_by_length(spark, sf_dir):
    return analyses.votes_by_length(line_reviews(spark, sf_dir))


@query("votes_by_length_clean", votes_sql(CLEAN_REVIEWS))
def votes_by_length_clean(spark, sf_dir):
    return analyses.votes_by_length(clean_reviews(raw_reviews(spark, sf_dir)))


USER_FREQUENCY = f"""
    WITH sized AS (
        SELECT *, COUNT(*) OVER (PARTITION BY "reviewerID") AS n FROM ({ORDER_REVIEWS}))
    SELECT CASE WHEN n >= 10 THEN 'high_frequency_user' ELSE 'ordinary_user' END AS user_group,
           COUNT(DISTINCT "reviewerID") AS user_count, COUNT(*) AS review_count,
           ROUND(AVG(n), 2) AS avg_reviews_per_user, ROUND(AVG(rating), 3) AS avg_rating,
           ROUND(STDDEV_SAMP(rating), 3) AS rating_stddev,
           ROUND(AVG(helpful_votes), 3) AS avg_helpful_votes,
           ROUND(AVG(review_length), 1) AS avg_review_length,
           ROUND(COUNT(*) FILTER (WHERE rating >= 4) * 100.0 / COUNT(*), 2)
               AS positive_review_pct
    FROM sized GROUP BY ALL
"""


@query("user_frequency", USER_FREQUENCY)
def user_frequency(spark, sf_dir):
    return analyses.user_frequency(order_reviews(spark, sf_dir))


PRICE_NUMBERS = range(1, len(PART_PRICE_LABELS) + 1)
PRICE_BUCKETS = f"""
    WITH priced AS (
        SELECT asin, rating, price,
               {bucket_sql("price", (PART_PRICE_EDGES, PRICE_NUMBERS))} AS bucket,
               {bucket_sql("price", (PART_PRICE_EDGES, quoted(PART_PRICE_LABELS)))} AS label
        FROM ({LINE_REVIEWS}) JOIN ({PART_PRODUCTS}) USING (asin)
        WHERE price IS NOT NULL AND price >= 0 AND rating IS NOT NULL)
    SELECT CAST(bucket AS INTEGER) AS price_bucket_order, label AS price_bucket,
           COUNT(*) AS review_count, COUNT(DISTINCT asin) AS product_count,
           ROUND(AVG(rating), 3) AS avg_rating, ROUND(STDDEV_SAMP(rating), 3) AS rating_stddev,
           ROUND(AVG(price), 2) AS avg_price
    FROM priced GROUP BY bucket, label
"""


@query("price_buckets", PRICE_BUCKETS)
def price_buckets(spark, sf_dir):
    return analyses.price_buckets(
        line_reviews(spark, sf_dir),
        part_products(spark, sf_dir),
        edges=PART_PRICE_EDGES,
        labels=PART_PRICE_LABELS,
    )


def _amounts(facts, group: str, key: str, amount: str):
    """Mean and deviation of unrounded amounts per group, collapsed to keys first."""
    measure = Moments("amount")
    collapsed = facts.groupBy(group, key).agg(*measure.of(amount))
    return (
        centred(collapsed, group, measure)
        .groupBy(group)
        .agg(
            F.sum(measure.count_col).alias("amounts"),
            F.round(measure.mean(), 4).alias("avg_amount"),
            F.round(measure.stddev(), 4).alias("amount_stddev"),
        )
    )


@query(
    "user_amounts",
    """
    SELECT o_orderstatus, COUNT(*) AS amounts, ROUND(AVG(o_totalprice), 4) AS avg_amount,
           ROUND(STDDEV_SAMP(o_totalprice), 4) AS amount_stddev
    FROM orders GROUP BY o_orderstatus
    """,
)
def user_amounts(spark, sf_dir):
    return _amounts(table(spark, sf_dir, "orders"), "o_orderstatus", "o_custkey", "o_totalprice")


@query(
    "price_bucket_amounts",
    """
    SELECT l_returnflag, COUNT(*) AS amounts,
           ROUND(AVG(l_extendedprice + 1e7), 4) AS avg_amount,
           ROUND(STDDEV_SAMP(l_extendedprice + 1e7), 4) AS amount_stddev
    FROM lineitem GROUP BY l_returnflag
    """,
)
def price_bucket_amounts(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("amount", F.col("l_extendedprice") + 1e7)
    return _amounts(lines, "l_returnflag", "l_partkey", "amount")


BRAND_RANKING = f"""
    SELECT COALESCE(NULLIF(trim(brand), ''), 'Unknown') AS brand, COUNT(*) AS review_count,
           COUNT(DISTINCT asin) AS product_count, ROUND(AVG(rating), 3) AS avg_rating,
           ROUND(STDDEV_SAMP(rating), 3) AS rating_stddev
    FROM ({LINE_REVIEWS}) JOIN ({PART_PRODUCTS}) USING (asin)
    WHERE rating IS NOT NULL
    GROUP BY 1 HAVING COUNT(*) >= 20
    ORDER BY review_count DESC, avg_rating DESC, brand LIMIT {{n}}
"""


@query("brand_ranking", BRAND_RANKING.format(n=30))
def brand_ranking(spark, sf_dir):
    return analyses.brand_ranking(line_reviews(spark, sf_dir), part_products(spark, sf_dir))


RATED_TEXTS = f"""
    SELECT *, CASE WHEN rating >= 4 THEN 'high_rating' ELSE 'low_rating' END AS sentiment_group
    FROM ({DOCUMENT_REVIEWS}) WHERE rating >= 4 OR rating <= 2
"""
KEYWORD_RANKING = ranked(cleaned(RATED_TEXTS, "sentiment_group"), "sentiment_group")


@query("keyword_ranking", KEYWORD_RANKING)
def keyword_ranking(spark, sf_dir):
    return analyses.keyword_ranking(document_reviews(spark, sf_dir))


@query("keyword_heavy_hitters", KEYWORD_RANKING)
def keyword_heavy_hitters(spark, sf_dir):
    return analyses.keyword_ranking(document_reviews(spark, sf_dir), heavy=True)


@query("join_bloom_reduced", PRICE_BUCKETS)
def join_bloom_reduced(spark, sf_dir):
    return analyses.price_buckets(
        line_reviews(spark, sf_dir),
        part_products(spark, sf_dir),
        edges=PART_PRICE_EDGES,
        labels=PART_PRICE_LABELS,
        reduce=True,
    )
