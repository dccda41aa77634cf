"""The review reports. Column names of the results are the published ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmill.functions.buckets import (
    LENGTH_EDGES,
    LENGTH_LABELS,
    PRICE_EDGES,
    PRICE_LABELS,
    bucket_label,
    bucket_order,
    percentage,
    rounded_mean,
    rounded_stddev,
)
from starmill.functions.parsing import blank_to_default
from starmill.functions.text import ASCII_WORD, STOP_WORDS, join_texts
from starmill.operators.heavy_hitters import rank_heavy_keywords
from starmill.operators.keywords import clean_tokens, rank_keywords
from starmill.operators.moments import Moments, overall_mean
from starmill.operators.ranking import share_of_total, top_n
from starmill.operators.semijoin import reduce_by_keys
from starmill.roles import REVIEW_ROLES, Roles

POSITIVE_SCORE = 4
NEGATIVE_SCORE = 2
FREQUENT_USER_REVIEWS = 10
MIN_BRAND_REVIEWS = 20
TOP_BRANDS = 30
TOP_KEYWORDS = 40


def yearly_trend(reviews: DataFrame, roles: Roles = REVIEW_ROLES) -> DataFrame:
    """Reviews, mean score and verified reviews per year; an unknown flag is unverified."""
    return (
        reviews.where(F.col(roles.year).isNotNull())
        .groupBy(F.col(roles.year).alias("review_year"))
        .agg(
            F.count("*").alias("review_count"),
            rounded_mean(roles.score, 3).alias("avg_rating"),
            F.count_if(roles.flag).alias("verified_review_count"),
        )
        .orderBy("review_year")
    )


def rating_distribution(reviews: DataFrame, roles: Roles = REVIEW_ROLES) -> DataFrame:
    """Reviews per score and their share of all scored reviews."""
    counts = (
        reviews.where(F.col(roles.score).isNotNull())
        .groupBy(F.col(roles.score).alias("rating"))
        .agg(F.count("*").alias("review_count"))
    )
    return share_of_total(counts, "review_count", "review_pct").orderBy("rating")


COMPARED = [
    "review_count", "avg_rating", "rating_stddev", "avg_helpful_votes", "avg_review_length"
]


def verified_compare(reviews: DataFrame, roles: Roles = REVIEW_ROLES) -> DataFrame:
    """Verified against other reviews; an unknown flag belongs to neither."""
    label = F.when(F.col("_flag"), "verified_purchase").otherwise("non_verified_purchase")
    return (
        reviews.where(F.col(roles.flag).isNotNull())
        .groupBy(F.col(roles.flag).alias("_flag"))
        .agg(
            F.count("*").alias("review_count"),
            rounded_mean(roles.score, 3).alias("avg_rating"),
            rounded_stddev(roles.score, 3).alias("rating_stddev"),
            rounded_mean(roles.votes, 3).alias("avg_helpful_votes"),
            rounded_mean(roles.length, 1).alias("avg_review_length"),
        )
        .orderBy(F.desc("_flag"))
        .select(label.alias("purchase_type"), *COMPARED)
    )


def votes_by_length(
    reviews: DataFrame,
    roles: Roles = REVIEW_ROLES,
    edges: Sequence[float] = LENGTH_EDGES,
    labels: Sequence[str] = LENGTH_LABELS,
) -> DataFrame:
    """Votes per whole score and text length bucket; scores beyond whole numbers' range
    are left out."""
    score, votes, length = (F.col(c) for c in (roles.score, roles.votes, roles.length))
    usable = reviews.select(
        score.try_cast("int").alias("rating"),
        bucket_order(length, edges).alias("review_length_bucket_order"),
        votes.alias("_votes"),
        length.alias("_length"),
    ).where(F.col("rating").isNotNull() & F.col("_votes").isNotNull() & F.col("_length").isNotNull())
    cell = ["rating", "review_length_bucket_order"]
    # One row per distinct number of votes of a cell: these spill, an exact median in an
    # aggregation buffer could not.
    counted = usable.groupBy(*cell, "_votes").agg(
        F.count("*").alias("_n"), F.sum("_length").alias("_length")
    )
    upward = Window.partitionBy(*cell).orderBy("_votes")
    ranked = counted.withColumns(
        {
            "_until": F.sum("_n").over(upward),
            "_all": F.sum("_n").over(Window.partitionBy(*cell)),
        }
    )
    middle = F.min(F.when(F.col("_until") * 2 >= F.col("_all"), F.col("_votes")))
    cells = ranked.groupBy(*cell).agg(
        F.sum("_n").alias("review_count"),
        F.round(F.sum(F.col("_votes") * F.col("_n")) / F.sum("_n"), 3).alias("avg_helpful_votes"),
        middle.cast("int").alias("median_helpful_votes"),
        F.round(F.sum("_length") / F.sum("_n"), 1).alias("avg_review_length"),
    )
    label = bucket_label(F.col("review_length_bucket_order"), labels, edges)
    return cells.select(
        "rating",
        "review_length_bucket_order",
        label.alias("review_length_bucket"),
        "review_count",
        "avg_helpful_votes",
        "median_helpful_votes",
        "avg_review_length",
    ).orderBy("rating", "review_length_bucket_order")


def user_frequency(
    reviews: DataFrame,
    roles: Roles = REVIEW_ROLES,
    min_reviews: int = FREQUENT_USER_REVIEWS,
    reviews_per_user: bool = False,
) -> DataFrame:
    """Frequent against ordinary users.

    Everything reported adds up over users, so the reviews collapse to one row per user
    and no review is joined with its user's total. ``avg_reviews_per_user`` is taken
    over reviews, as published; ``reviews_per_user`` adds the mean over users.
    """
    score, votes, length = Moments("score"), Moments("votes"), Moments("length")
    users = (
        reviews.where(F.col(roles.user).isNotNull())
        .groupBy(roles.user)
        .agg(
            F.count("*").alias("n"),
            F.count_if(F.col(roles.score) >= POSITIVE_SCORE).alias("positive"),
            *score.of(roles.score),
            *votes.of(roles.votes),
            *length.of(roles.length),
        )
    )
    group = F.when(F.col("n") >= min_reviews, "high_frequency_user").otherwise("ordinary_user")
    weighted = F.sum(F.col("n").cast("double") * F.col("n"))
    extra = [F.round(F.avg("n"), 2).alias("reviews_per_user")] if reviews_per_user else []
    centre = overall_mean(users, score)
    return (
        users.groupBy(group.alias("user_group"))
        .agg(
            F.count("*").alias("user_count"),
            F.sum("n").alias("review_count"),
            F.round(weighted / F.sum("n"), 2).alias("avg_reviews_per_user"),
            F.round(score.mean(), 3).alias("avg_rating"),
            F.round(score.stddev(centre), 3).alias("rating_stddev"),
            F.round(votes.mean(), 3).alias("avg_helpful_votes"),
            F.round(length.mean(), 1).alias("avg_review_length"),
            percentage(F.sum("positive"), F.sum("n")).alias("positive_review_pct"),
            *extra,
        )
        .orderBy(F.when(F.col("user_group") == "high_frequency_user", 1).otherwise(2))
    )


def _scores_per_item(
    reviews: DataFrame, roles: Roles, score: Moments, wanted: DataFrame | None = None
) -> DataFrame:
    """Scored reviews collapsed to one row per item, ready to meet the product table.

    Joining items instead of reviews keeps a best-selling item to a single row and
    moves none of the review rows. Of reviews whose item is not ``wanted`` most go ahead
    of the aggregation.
    """
    if wanted is not None:
        reviews = reduce_by_keys(reviews, wanted, roles.item)
    return (
        reviews.where(F.col(roles.item).isNotNull() & F.col(roles.score).isNotNull())
        .groupBy(roles.item)
        .agg(*score.of(roles.score))
    )


def price_buckets(
    reviews: DataFrame,
    products: DataFrame,
    roles: Roles = REVIEW_ROLES,
    edges: Sequence[float] = PRICE_EDGES,
    labels: Sequence[str] = PRICE_LABELS,
    reduce: bool = False,
) -> DataFrame:
    """Reviews, products and scores per price bucket; unpriced products are left out.

    ``reduce`` gives the same rows; it keeps reviews of unpriced items out of the shuffle,
    for a pass over the products beforehand.
    """
    score, price = Moments("score"), F.col(roles.price)
    priced = products.where(price.isNotNull() & (price >= 0)).select(roles.item, roles.price)
    collapsed = _scores_per_item(reviews, roles, score, priced if reduce else None)
    centre = overall_mean(collapsed, score)
    items = collapsed.join(priced, roles.item)
    paid = F.sum(price * F.col(score.count_col))
    buckets = items.groupBy(bucket_order(price, edges).alias("price_bucket_order")).agg(
        F.sum(score.count_col).alias("review_count"),
        F.count_distinct(roles.item).alias("product_count"),
        F.round(score.mean(), 3).alias("avg_rating"),
        F.round(score.stddev(centre), 3).alias("rating_stddev"),
        F.round(paid / F.sum(score.count_col), 2).alias("avg_price"),
    )
    label = bucket_label(F.col("price_bucket_order"), labels, edges)
    return buckets.select(
        "price_bucket_order",
        label.alias("price_bucket"),
        "review_count",
        "product_count",
        "avg_rating",
        "rating_stddev",
        "avg_price",
    ).orderBy("price_bucket_order")


def brand_ranking(
    reviews: DataFrame,
    products: DataFrame,
    roles: Roles = REVIEW_ROLES,
    min_reviews: int = MIN_BRAND_REVIEWS,
    n: int = TOP_BRANDS,
) -> DataFrame:
    """Most reviewed brands among those with enough reviews."""
    score = Moments("score")
    branded = products.select(
        roles.item, blank_to_default(F.col(roles.brand), "Unknown").alias("brand")
    )
    collapsed = _scores_per_item(reviews, roles, score)
    centre = overall_mean(collapsed, score)
    brands = (
        collapsed.join(branded, roles.item)
        .groupBy("brand")
        .agg(
            F.sum(score.count_col).alias("review_count"),
            F.count_distinct(roles.item).alias("product_count"),
            F.round(score.mean(), 3).alias("avg_rating"),
            F.round(score.stddev(centre), 3).alias("rating_stddev"),
        )
        .where(F.col("review_count") >= min_reviews)
    )
    return top_n(brands, [F.desc("review_count"), F.desc("avg_rating"), F.asc("brand")], n)


def keyword_ranking(
    reviews: DataFrame,
    roles: Roles = REVIEW_ROLES,
    k: int = TOP_KEYWORDS,
    stop_words: Sequence[str] = STOP_WORDS,
    word_chars: str = ASCII_WORD,
    heavy: bool = False,
) -> DataFrame:
    """Most frequent keywords of good and of bad reviews; scores between are left out.

    ``heavy`` gives the same rows without shuffling the vocabulary, for two passes over
    the texts.
    """
    score = F.col(roles.score)
    group = F.when(score >= POSITIVE_SCORE, "high_rating").when(
        score <= NEGATIVE_SCORE, "low_rating"
    )
    polar = reviews.where((score >= POSITIVE_SCORE) | (score <= NEGATIVE_SCORE))
    tokens = clean_tokens(
        polar.withColumn("sentiment_group", group),
        join_texts(F.col(roles.headline), F.col(roles.body)),
        ["sentiment_group"],
        stop_words,
        word_chars=word_chars,
    )
    rank = rank_heavy_keywords if heavy else rank_keywords
    return rank(tokens, "sentiment_group", k=k)
