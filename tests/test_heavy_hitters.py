"""Keywords from summaries equal those from the whole vocabulary, also when flat."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from starmill.operators import heavy_hitters
from starmill.operators.heavy_hitters import rank_heavy_keywords
from starmill.operators.keywords import rank_keywords
from tests.conftest import rows


@pytest.fixture
def widths(monkeypatch):
    """The summary widths that a ranking went through."""
    seen = []
    summarise = heavy_hitters._candidates
    monkeypatch.setattr(
        heavy_hitters, "_candidates", lambda t, g, width: seen.append(width) or summarise(t, g, width)
    )
    return seen


def zipf(spark, words=3000):
    """Word i occurs about words / i times, in two groups, a third of all rows one word."""
    ranks = spark.range(1, words + 1).select(F.col("id").alias("i"))
    times = F.floor(F.lit(words) / F.col("i")).cast("int")
    repeated = ranks.select("i", F.explode(F.sequence(F.lit(1), times)).alias("t"))
    return repeated.select(
        F.when(F.col("t") % 3 == 0, "a").otherwise("b").alias("g"),
        F.concat(F.lit("w"), "i").alias("token"),
    ).repartition(7)


def test_a_steep_distribution_is_certain_at_once(spark, widths):
    tokens = zipf(spark)
    assert rows(rank_heavy_keywords(tokens, "g", k=10, tracked=512)) == rows(rank_keywords(tokens, "g", k=10))
    assert widths == [512]


def test_a_flat_distribution_widens(spark, widths):
    """2,000 words three times each: nothing but the whole vocabulary proves the order."""
    tokens = spark.range(6000).select(F.lit("g").alias("g"), F.concat(F.lit("w"), F.col("id") % 2000).alias("token"))
    ours = rank_heavy_keywords(tokens.repartition(5), "g", k=5, tracked=16)
    assert rows(ours) == rows(rank_keywords(tokens, "g", k=5))
    assert widths[:3] == [16, 256, 4096] and len(widths) == 3


def test_what_summaries_cannot_settle_is_counted_whole(spark, widths):
    tokens = spark.range(6000).select(F.lit("g").alias("g"), F.concat(F.lit("w"), F.col("id") % 2000).alias("token"))
    ours = rank_heavy_keywords(tokens, "g", k=5, tracked=16, widest=256)
    assert rows(ours) == rows(rank_keywords(tokens, "g", k=5))
    assert widths == [16, 256]


def test_many_groups_are_counted_whole(spark, monkeypatch):
    monkeypatch.setattr(heavy_hitters, "MOST_CANDIDATES", 3)
    tokens = zipf(spark, 60)
    assert rows(rank_heavy_keywords(tokens, "g", k=5, tracked=64)) == rows(rank_keywords(tokens, "g", k=5))


def test_nulls_short_groups_and_no_tokens(spark):
    data = [("a", "x"), ("a", "x"), ("a", None), (None, "x"), ("b", "y")]
    tokens = spark.createDataFrame(data, "g string, token string")
    assert rows(rank_heavy_keywords(tokens, "g", k=3)) == [
        ("a", 1, "x", 2, 10000.0), ("b", 1, "y", 1, 10000.0)
    ]
    assert rows(rank_heavy_keywords(tokens.limit(0), "g", k=3)) == []


def test_a_word_beside_the_candidates_is_noticed(spark):
    """The k-th candidate must beat the fullest cell, not only match it."""
    counted = spark.createDataFrame(
        [("a", "x", None, 5), ("a", None, 1, 5), ("b", "x", None, 6), ("b", None, 1, 5), ("c", None, 1, 1)],
        "g string, keyword string, cell long, keyword_count long",
    )
    found = heavy_hitters.uncertain_groups(counted, "g", 1)
    assert sorted(rows(found)) == [("a",), ("c",)]
