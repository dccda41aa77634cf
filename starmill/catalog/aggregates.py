"""Aggregations over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from starmill.catalog.bindings import (
    LINE_REVIEWS,
    PART_PRODUCTS,
    line_reviews,
    part_products,
    table,
)
from starmill.catalog.registry import query
from starmill.functions.buckets import median_value, percentage, rounded_mean, rounded_stddev
from starmill.operators.sketches import (
    RANK_ERROR,
    dense_ids,
    distinct_bitmaps,
    distinct_from,
    merged_quantile,
    quantile_sketches,
    rank_errors,
)
from starmill.plans.helpful_model import median_price
from starmill.session import materialise


@query(
    "agg_count",
    "SELECT l_suppkey, COUNT(*) AS lines FROM lineitem GROUP BY l_suppkey",
)
def agg_count(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("lines"))


@query(
    "agg_count_if",
    f"""
    SELECT asin, COUNT(*) AS reviews, CAST(SUM(CASE WHEN verified THEN 1 ELSE 0 END) AS BIGINT)
           AS verified_reviews
    FROM ({LINE_REVIEWS}) GROUP BY asin
    """,
)
def agg_count_if(spark, sf_dir):
    return (
        line_reviews(spark, sf_dir)
        .groupBy("asin")
        .agg(F.count("*").alias("reviews"), F.count_if("verified").alias("verified_reviews"))
    )


@query(
    "agg_avg",
    f"""
    SELECT review_year, ROUND(AVG(rating), 3) AS avg_rating,
           ROUND(AVG(helpful_votes), 3) AS avg_votes, ROUND(AVG(review_length), 1) AS avg_length
    FROM ({LINE_REVIEWS}) GROUP BY review_year
    """,
)
def agg_avg(spark, sf_dir):
    return (
        line_reviews(spark, sf_dir)
        .groupBy("review_year")
        .agg(
            rounded_mean("rating", 3).alias("avg_rating"),
            rounded_mean("helpful_votes", 3).alias("avg_votes"),
            rounded_mean("review_length", 1).alias("avg_length"),
        )
    )


@query(
    "agg_stddev",
    f"""
    SELECT "reviewerID" AS reviewer, ROUND(STDDEV_SAMP(rating), 3) AS rating_stddev
    FROM ({LINE_REVIEWS}) GROUP BY "reviewerID"
    """,
)
def agg_stddev(spark, sf_dir):
    return (
        line_reviews(spark, sf_dir)
        .groupBy(F.col("reviewerID").alias("reviewer"))
        .agg(rounded_stddev("rating", 3).alias("rating_stddev"))
    )


@query(
    "agg_count_distinct",
    """
    SELECT l_returnflag, COUNT(DISTINCT l_partkey) AS parts, COUNT(*) AS lines
    FROM lineitem GROUP BY l_returnflag
    """,
)
def agg_count_distinct(spark, sf_dir):
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_returnflag")
        .agg(F.count_distinct("l_partkey").alias("parts"), F.count("*").alias("lines"))
    )


MEDIAN_VOTES = f"""
    SELECT rating, quantile_disc(helpful_votes, 0.5) AS median_votes
    FROM ({LINE_REVIEWS}) GROUP BY rating
"""


@query("agg_median", MEDIAN_VOTES)
def agg_median(spark, sf_dir):
    median = F.percentile_approx("helpful_votes", 0.5)
    return line_reviews(spark, sf_dir).groupBy("rating").agg(median.alias("median_votes"))


@query("agg_median_exact", MEDIAN_VOTES)
def agg_median_exact(spark, sf_dir):
    median = median_value("helpful_votes").cast("int")
    return line_reviews(spark, sf_dir).groupBy("rating").agg(median.alias("median_votes"))


@query(
    "global_median",
    f"SELECT quantile_disc(price, 0.5) AS median_price FROM ({PART_PRODUCTS})",
)
def global_median(spark, sf_dir):
    return median_price(part_products(spark, sf_dir))


@query(
    "agg_pct",
    f"""
    SELECT review_year, ROUND(CAST(SUM(CASE WHEN rating >= 4 THEN 1 ELSE 0 END) AS BIGINT)
                              * 100.0 / COUNT(*), 2) AS positive_pct
    FROM ({LINE_REVIEWS}) GROUP BY review_year
    """,
)
def agg_pct(spark, sf_dir):
    positive = F.count_if(F.col("rating") >= 4)
    return (
        line_reviews(spark, sf_dir)
        .groupBy("review_year")
        .agg(percentage(positive, F.count("*")).alias("positive_pct"))
    )


@query(
    "global_agg",
    f"""
    SELECT COUNT(*) AS reviews, ROUND(AVG(rating), 6) AS avg_rating,
           ROUND(AVG(CASE WHEN helpful_votes > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6)
               AS helpful_rate,
           CAST(SUM(review_length) AS BIGINT) AS chars
    FROM ({LINE_REVIEWS})
    """,
)
def global_agg(spark, sf_dir):
    helpful = F.when(F.col("helpful_votes") > 0, 1.0).otherwise(0.0)
    return line_reviews(spark, sf_dir).agg(
        F.count("*").alias("reviews"),
        rounded_mean("rating", 6).alias("avg_rating"),
        rounded_mean(helpful, 6).alias("helpful_rate"),
        F.sum("review_length").alias("chars"),
    )


@query(
    "agg_multi_key",
    """
    SELECT CAST(year(l_shipdate) AS INTEGER) AS ship_year, l_returnflag, l_linestatus,
           COUNT(*) AS lines, CAST(SUM(l_quantity) AS DOUBLE) AS quantity
    FROM lineitem GROUP BY ALL
    """,
)
def agg_multi_key(spark, sf_dir):
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.year("l_shipdate").alias("ship_year"), "l_returnflag", "l_linestatus")
        .agg(F.count("*").alias("lines"), F.sum("l_quantity").alias("quantity"))
    )


@query(
    "having_min_count",
    f"""
    SELECT asin, COUNT(*) AS review_count FROM ({LINE_REVIEWS})
    GROUP BY asin HAVING COUNT(*) >= 20
    """,
)
def having_min_count(spark, sf_dir):
    return (
        line_reviews(spark, sf_dir)
        .groupBy("asin")
        .agg(F.count("*").alias("review_count"))
        .where("review_count >= 20")
    )


@query(
    "median_from_sketches",
    f"""
    SELECT rating, COUNT(review_length) AS n, true AS within_error
    FROM ({LINE_REVIEWS}) WHERE rating IS NOT NULL GROUP BY rating
    """,
)
def median_from_sketches(spark, sf_dir):
    """Medians of lengths from stored sketches of each year, against their exact ranks."""
    reviews = line_reviews(spark, sf_dir).where("rating IS NOT NULL")
    sketches = materialise(quantile_sketches(reviews, ["rating"], "review_year", "review_length"), "length-sketches")
    found = merged_quantile(sketches, ["rating"])
    errors = rank_errors(reviews, found, ["rating"], "review_length", 0.5)
    return errors.select("rating", "n", (F.col("rank_error") <= RANK_ERROR).alias("within_error"))


@query(
    "distinct_from_bitmaps",
    """
    SELECT l_returnflag, COUNT(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY l_returnflag
    """,
)
def distinct_from_bitmaps(spark, sf_dir):
    """Distinct parts of a flag from bitmaps stored per ship year."""
    lines = table(spark, sf_dir, "lineitem").withColumn("ship_year", F.year("l_shipdate"))
    ids = dense_ids(lines, "l_partkey")
    bitmaps = distinct_bitmaps(lines, ids, ["l_returnflag"], "ship_year", "l_partkey")
    return distinct_from(materialise(bitmaps, "part-bitmaps"), ["l_returnflag"], "parts")
