"""Chart feeds over the reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from starmill.catalog import analyses as reports
from starmill.catalog.registry import query
from starmill.plans import charts


@query("chart_yearly", f"SELECT review_year, review_count FROM ({reports.YEARLY_TREND})")
def chart_yearly(spark, sf_dir):
    return charts.yearly_series(reports.yearly_trend(spark, sf_dir))


@query("chart_rating", f"SELECT rating, review_count FROM ({reports.RATING_DISTRIBUTION})")
def chart_rating(spark, sf_dir):
    return charts.rating_bars(reports.rating_distribution(spark, sf_dir))


@query(
    "chart_verified",
    f"""
    SELECT CASE purchase_type WHEN 'verified_purchase' THEN 'Verified Purchase'
                              ELSE 'Non Verified Purchase' END AS purchase_label, avg_rating
    FROM ({reports.VERIFIED_COMPARE})
    """,
)
def chart_verified(spark, sf_dir):
    return charts.verified_bars(reports.verified_compare(spark, sf_dir))


@query(
    "chart_bucket_order",
    f"""
    SELECT DISTINCT review_length_bucket_order, review_length_bucket
    FROM ({reports.VOTES_BY_LENGTH})
    """,
)
def chart_bucket_order(spark, sf_dir):
    return charts.length_bucket_order(reports.votes_by_length(spark, sf_dir))


@query(
    "chart_pivot",
    f"""
    SELECT rating, {", ".join(
        f"AVG(avg_helpful_votes) FILTER (WHERE review_length_bucket_order = {i}) AS \"{label}\""
        for i, label in enumerate(charts.LENGTH_LABELS, start=1)
    )}
    FROM ({reports.VOTES_BY_LENGTH}) GROUP BY rating
    """,
)
def chart_pivot(spark, sf_dir):
    return charts.votes_heat_map(reports.votes_by_length(spark, sf_dir))


@query(
    "chart_user_groups",
    f"""
    SELECT CASE user_group WHEN 'ordinary_user' THEN 'Ordinary User'
                           ELSE 'High Frequency User' END AS user_group_label,
           avg_rating, positive_review_pct
    FROM ({reports.USER_FREQUENCY})
    """,
)
def chart_user_groups(spark, sf_dir):
    return charts.user_group_bars(reports.user_frequency(spark, sf_dir))


@query(
    "chart_price",
    f"""
    SELECT price_bucket_order, price_bucket, review_count, avg_rating
    FROM ({reports.PRICE_BUCKETS})
    """,
)
def chart_price(spark, sf_dir):
    return charts.price_bars(reports.price_buckets(spark, sf_dir))


@query(
    "chart_top_brands",
    f"""
    SELECT substr(brand, 1, 45) AS brand_label, review_count, avg_rating
    FROM ({reports.BRAND_RANKING.format(n=15)})
    """,
)
def chart_top_brands(spark, sf_dir):
    return charts.brand_bars(reports.brand_ranking(spark, sf_dir))


@query(
    "chart_keywords",
    f"""
    SELECT CASE sentiment_group WHEN 'high_rating' THEN 'High Rating' ELSE 'Low Rating' END
               AS sentiment_label, keyword_rank, keyword, keyword_count
    FROM ({reports.KEYWORD_RANKING}) WHERE keyword_rank <= 15
    """,
)
def chart_keywords(spark, sf_dir):
    return charts.keyword_bars(reports.keyword_ranking(spark, sf_dir))


@query("chart_keyword_map")
def chart_keyword_map(spark, sf_dir):
    return charts.keyword_weights(reports.keyword_ranking(spark, sf_dir))


@query(
    "chart_keyword_weights",
    f"SELECT sentiment_group, keyword, keyword_count FROM ({reports.KEYWORD_RANKING})",
)
def chart_keyword_weights(spark, sf_dir):
    """The weight maps with a row per entry."""
    weights = charts.keyword_weights(reports.keyword_ranking(spark, sf_dir))
    entries = F.explode("keyword_counts").alias("keyword", "keyword_count")
    return weights.select("sentiment_group", entries)
