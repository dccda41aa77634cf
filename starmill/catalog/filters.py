"""Row filters over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from starmill.catalog.bindings import (
    DOCUMENT_REVIEWS,
    LINE_REVIEWS,
    document_reviews,
    line_reviews,
    table,
)
from starmill.catalog.registry import query
from starmill.functions.text import STOP_WORDS, join_texts, word_array

STOP_WORDS_SQL = ", ".join(f"'{word}'" for word in STOP_WORDS)


@query(
    "filter_not_null",
    f"""
    SELECT asin, rating, helpful_votes, review_year FROM ({LINE_REVIEWS})
    WHERE rating IS NOT NULL AND helpful_votes IS NOT NULL AND review_year IS NOT NULL
    """,
)
def filter_not_null(spark, sf_dir):
    return (
        line_reviews(spark, sf_dir)
        .where(
            F.col("rating").isNotNull()
            & F.col("helpful_votes").isNotNull()
            & F.col("review_year").isNotNull()
        )
        .select("asin", "rating", "helpful_votes", "review_year")
    )


@query(
    "filter_range",
    """
    SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
    WHERE l_extendedprice >= 20000 AND l_extendedprice < 60000
    """,
)
def filter_range(spark, sf_dir):
    price = F.col("l_extendedprice")
    return (
        table(spark, sf_dir, "lineitem")
        .where((price >= 20_000) & (price < 60_000))
        .select("l_orderkey", "l_linenumber", "l_extendedprice")
    )


@query(
    "filter_or",
    f"SELECT asin, rating FROM ({LINE_REVIEWS}) WHERE rating >= 4 OR rating <= 2",
)
def filter_or(spark, sf_dir):
    polar = (F.col("rating") >= 4) | (F.col("rating") <= 2)
    return line_reviews(spark, sf_dir).where(polar).select("asin", "rating")


WORDS = f"""
    SELECT "reviewerID" AS doc_id, unnest(regexp_extract_all(
        lower(regexp_replace(summary || ' ' || "reviewText", '[^a-zA-Z0-9 ]', ' ', 'g')),
        '[^ ]+')) AS word
    FROM ({DOCUMENT_REVIEWS})
"""


def _words(spark, sf_dir):
    text = join_texts(F.col("summary"), F.col("reviewText"))
    return (
        document_reviews(spark, sf_dir)
        .select(F.col("reviewerID").alias("doc_id"), F.explode(word_array(text)).alias("word"))
        .select("doc_id", F.lower("word").alias("word"))
    )


def _per_document(words):
    return words.groupBy("doc_id").agg(
        F.count("*").alias("words"), F.min("word").alias("first"), F.max("word").alias("last")
    )


PER_DOCUMENT = """
    SELECT doc_id, COUNT(*) AS words, MIN(word) AS first, MAX(word) AS last
    FROM ({words}) WHERE {condition} GROUP BY doc_id
"""


@query(
    "filter_not_in",
    PER_DOCUMENT.format(words=WORDS, condition=f"word NOT IN ({STOP_WORDS_SQL})"),
)
def filter_not_in(spark, sf_dir):
    return _per_document(_words(spark, sf_dir).where(~F.col("word").isin(list(STOP_WORDS))))


@query(
    "filter_not_rlike",
    PER_DOCUMENT.format(words=WORDS, condition="NOT regexp_matches(word, '^[0-9]+$')"),
)
def filter_not_rlike(spark, sf_dir):
    return _per_document(_words(spark, sf_dir).where(~F.col("word").rlike("^[0-9]+$")))


@query("filter_length", PER_DOCUMENT.format(words=WORDS, condition="length(word) >= 3"))
def filter_length(spark, sf_dir):
    return _per_document(_words(spark, sf_dir).where(F.length("word") >= 3))
