"""Reports as SQL text over session functions and named parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from starmill.catalog.analyses import KEYWORD_RANKING, VOTES_BY_LENGTH
from starmill.catalog.bindings import (
    LINE_REVIEWS,
    RAW_PRODUCTS,
    document_reviews,
    line_reviews,
    raw_products,
)
from starmill.catalog.registry import query
from starmill.catalog.scalars import bucket_sql, quoted
from starmill.functions.buckets import PRICE_EDGES, PRICE_LABELS
from starmill.functions.parsing import BY_PREFIX_PATTERN, PRICE_PATTERN
from starmill.functions.text import STOP_WORDS
from starmill.sources.readers import register_views
from starmill.sources.sql_functions import register_functions


@query("sql_report_votes", VOTES_BY_LENGTH)
def sql_report_votes(spark, sf_dir):
    register_functions(spark)
    register_views({"sql_reviews": line_reviews(spark, sf_dir)})
    return spark.sql(
        """
        SELECT rating, review_length_bucket_order, review_length_bucket, COUNT(*) AS review_count,
               ROUND(AVG(helpful_votes), 3) AS avg_helpful_votes,
               percentile_approx(helpful_votes, 0.5, :accuracy) AS median_helpful_votes,
               ROUND(AVG(review_length), 1) AS avg_review_length
        FROM (SELECT try_cast(rating AS INT) AS rating, helpful_votes, review_length,
                     length_bucket(review_length) AS review_length_bucket_order,
                     length_label(review_length) AS review_length_bucket
              FROM sql_reviews WHERE helpful_votes IS NOT NULL AND review_length IS NOT NULL)
        WHERE rating IS NOT NULL
        GROUP BY rating, review_length_bucket_order, review_length_bucket
        ORDER BY rating, review_length_bucket_order
        """,
        {"accuracy": 10_000},
    )


BRAND_PRICES = rf"""
    WITH parsed AS (
        SELECT regexp_replace(regexp_replace(COALESCE(brand, ''), '{BY_PREFIX_PATTERN}', '', 'g'),
                              '\s+', ' ', 'g') AS brand,
               TRY_CAST(replace(regexp_extract(price, '{PRICE_PATTERN}', 1), ',', '') AS DOUBLE) AS price
        FROM ({RAW_PRODUCTS})
    )
    SELECT CAST({bucket_sql("price", (PRICE_EDGES, range(1, len(PRICE_LABELS) + 1)))} AS INTEGER)
               AS price_bucket_order,
           {bucket_sql("price", (PRICE_EDGES, quoted(PRICE_LABELS)))} AS price_bucket,
           COUNT(*) AS product_count, COUNT(DISTINCT brand) AS brands, ROUND(AVG(price), 2) AS avg_price
    FROM parsed WHERE price >= 5 GROUP BY 1, 2
"""


@query("sql_report_prices", BRAND_PRICES)
def sql_report_prices(spark, sf_dir):
    register_functions(spark)
    register_views({"sql_products": raw_products(spark, sf_dir)})
    return spark.sql(
        """
        SELECT price_bucket(price) AS price_bucket_order, price_label(price) AS price_bucket,
               COUNT(*) AS product_count, COUNT(DISTINCT brand) AS brands, ROUND(AVG(price), 2) AS avg_price
        FROM (SELECT parse_price(price) AS price, clean_brand(brand) AS brand FROM sql_products)
        WHERE price >= :least GROUP BY 1, 2 ORDER BY 1
        """,
        {"least": 5},
    )


@query("sql_report_keywords", KEYWORD_RANKING)
def sql_report_keywords(spark, sf_dir):
    register_functions(spark)
    register_views({"sql_texts": document_reviews(spark, sf_dir)})
    return spark.sql(
        """
        WITH counts AS (
            SELECT sentiment_group, word AS keyword, COUNT(*) AS keyword_count
            FROM (SELECT CASE WHEN rating >= 4 THEN 'high_rating' ELSE 'low_rating' END AS sentiment_group,
                         concat_ws(' ', coalesce(summary, ''), coalesce(reviewText, '')) AS body
                  FROM sql_texts WHERE rating >= 4 OR rating <= 2) AS texts,
                 LATERAL words(texts.body, :min_chars)
            WHERE NOT array_contains(:stop_words, word) AND NOT word RLIKE '^[0-9]+$'
            GROUP BY sentiment_group, word
        ), ranked AS (
            SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sentiment_group
                                                        ORDER BY keyword_count DESC, keyword) AS keyword_rank
                           FROM counts) WHERE keyword_rank <= :k
        ), totals AS (
            SELECT sentiment_group, SUM(keyword_count) AS total FROM counts GROUP BY sentiment_group
        )
        SELECT sentiment_group, keyword_rank, keyword, keyword_count,
               CAST(ROUND(keyword_count * 10000.0 / total, 2) AS DOUBLE) AS frequency_per_10k_words
        FROM ranked JOIN totals USING (sentiment_group) ORDER BY sentiment_group, keyword_rank
        """,
        {"min_chars": 3, "stop_words": F.array(*map(F.lit, STOP_WORDS)), "k": 40},
    )
