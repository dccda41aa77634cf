"""Reports on toy tables: null rules, ties, thresholds, and stability."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from starmill.operators.joins import with_group_size
from starmill.plans import analyses, charts
from starmill.roles import Roles
from tests.conftest import plan, review, rows


def test_yearly_trend_counts_unknown_flags_as_unverified(reviews_of):
    df = reviews_of(
        review(year=2012, rating=5.0),
        review(year=2012, rating=4.0, verified=None),
        review(year=2011, rating=1.0, verified=False),
        review(year=None),
    )
    assert rows(analyses.yearly_trend(df)) == [(2011, 1, 1.0, 0), (2012, 2, 4.5, 1)]


def test_rating_distribution(reviews_of):
    df = reviews_of(*[review(rating=r) for r in (5.0, 5.0, 1.0, None)])
    report = analyses.rating_distribution(df)
    assert rows(report) == [(1.0, 1, 33.33), (5.0, 2, 66.67)]
    assert report.schema["review_pct"].dataType.simpleString() == "double"


def test_verified_compare_leaves_unknown_flags_out(reviews_of):
    df = reviews_of(
        review(rating=5.0, votes=1, length=10),
        review(rating=2.0, votes=None, length=21),
        review(rating=3.0, verified=False),
        review(verified=None),
    )
    assert rows(analyses.verified_compare(df)) == [
        ("verified_purchase", 2, 3.5, 2.121, 1.0, 15.5),
        ("non_verified_purchase", 1, 3.0, None, 0.0, 10.0),
    ]


def test_votes_by_length(reviews_of):
    df = reviews_of(
        *[review(rating=4.5, votes=v, length=99) for v in (1, 2, 3, 10)],
        review(rating=4.0, votes=1, length=1500),
        review(rating=4.0, votes=None, length=5),
        review(rating=None, votes=1, length=5),
    )
    assert rows(analyses.votes_by_length(df)) == [
        (4, 1, "0-99 chars", 4, 4.0, 2, 99.0),
        (4, 5, "1500+ chars", 1, 1.0, 1, 1500.0),
    ]


def frequent_and_rare(reviews_of):
    many = [review(user="many", time=i, rating=float(i % 5 + 1), votes=i) for i in range(12)]
    few = [review(user=f"few{i}", rating=4.0, votes=None) for i in range(3)]
    return reviews_of(*many, *few, review(user="few0", rating=None), review(user=None))


def test_user_frequency(reviews_of):
    report = rows(analyses.user_frequency(frequent_and_rare(reviews_of), reviews_per_user=True))
    assert report == [
        ("high_frequency_user", 1, 12, 12.0, 2.75, 1.485, 5.5, 10.0, 33.33, 12.0),
        ("ordinary_user", 3, 4, 1.5, 4.0, 0.0, 0.0, 10.0, 75.0, 1.33),
    ]


def test_user_frequency_equals_the_joined_form(reviews_of):
    """Collapsing to users first gives what joining each review with its total gives."""
    df = frequent_and_rare(reviews_of)
    joined = with_group_size(df, "reviewerID", "n")
    group = F.when(F.col("n") >= 10, "high_frequency_user").otherwise("ordinary_user")
    expected = joined.groupBy(group.alias("g")).agg(
        F.count_distinct("reviewerID"),
        F.count("*"),
        F.round(F.avg("n"), 2),
        F.round(F.avg("rating"), 3),
        F.round(F.stddev_samp("rating"), 3),
        F.round(F.avg("helpful_votes"), 3),
        F.round(F.avg("review_length"), 1),
        F.round(F.count_if(F.col("rating") >= 4) * 100.0 / F.count("*"), 2),
    )
    assert rows(analyses.user_frequency(df)) == sorted(rows(expected))


def test_user_frequency_joins_nothing(reviews_of):
    assert "Join" not in plan(analyses.user_frequency(frequent_and_rare(reviews_of)))


def test_price_buckets_leave_unpriced_products_out(reviews_of, products_of):
    reviews = reviews_of(
        review(item="a", rating=5.0), review(item="a", rating=4.0), review(item="b", rating=1.0),
        review(item="c"), review(item="x"), review(item="a", rating=None),
    )
    products = products_of(("a", 9.99, "A"), ("b", 9.0, "B"), ("c", None, "C"), ("d", 10.0, "D"))
    assert rows(analyses.price_buckets(reviews, products)) == [
        (1, "$0-9.99", 3, 2, 3.333, 2.082, 9.66)
    ]


def test_price_edges_belong_to_the_next_bucket(reviews_of, products_of):
    prices = [0.0, 9.99, 10.0, 24.99, 25.0, 50.0, 75.0, 100.0, 1299.99]
    reviews = reviews_of(*[review(item=str(p)) for p in prices])
    products = products_of(*[(str(p), p, "") for p in prices])
    report = analyses.price_buckets(reviews, products)
    assert [(r[0], r[2]) for r in rows(report)] == [(1, 2), (2, 2), (3, 1), (4, 1), (5, 1), (6, 2)]


def test_duplicate_products_count_as_the_join_does(reviews_of, products_of):
    reviews = reviews_of(review(item="a", rating=5.0), review(item="a", rating=1.0))
    products = products_of(("a", 5.0, "A"), ("a", 6.0, "A"))
    assert rows(analyses.price_buckets(reviews, products))[0][2:4] == (4, 1)


def test_brand_ranking(reviews_of, products_of):
    reviews = reviews_of(
        *[review(item=i, rating=r) for i in "abcdef" for r in (5.0, 3.0)], review(item="g")
    )
    products = products_of(
        ("a", 1.0, "Zeta"), ("b", 1.0, " Alpha "), ("c", 1.0, None), ("d", 1.0, " "),
        ("e", 1.0, "Zeta"), ("f", 1.0, "Beta"), ("g", 1.0, "Rare"),
    )
    ranking = analyses.brand_ranking(reviews, products, min_reviews=2)
    assert [r[:3] for r in rows(ranking)] == [
        ("Unknown", 4, 2), ("Zeta", 4, 2), ("Alpha", 2, 1), ("Beta", 2, 1)
    ]
    assert "TakeOrderedAndProject" in plan(ranking)
    assert rows(analyses.brand_ranking(reviews, products)) == []


def test_keyword_ranking(reviews_of):
    df = reviews_of(
        review(rating=5.0, summary="Great mouse", body="great, great 100"),
        review(rating=2.0, summary=None, body="broken mouse don't"),
        review(rating=3.0, body="middling"),
        review(rating=None, body="unknown"),
    )
    assert rows(analyses.keyword_ranking(df)) == [
        ("high_rating", 1, "great", 3, 7500.0),
        ("high_rating", 2, "mouse", 1, 2500.0),
        ("low_rating", 1, "broken", 1, 5000.0),
        ("low_rating", 2, "mouse", 1, 5000.0),
    ]


def test_keywords_come_from_whole_texts(reviews_of):
    df = reviews_of(review(body="x" * 2000 + " tailword"))
    assert ("tailword",) in rows(analyses.keyword_ranking(df).select("keyword"))


def test_reports_take_other_column_names(spark):
    df = spark.createDataFrame([(2001, 4.0, True)], "y int, s double, f boolean")
    roles = Roles(year="y", score="s", flag="f")
    assert rows(analyses.yearly_trend(df, roles)) == [(2001, 1, 4.0, 1)]


@pytest.mark.parametrize("parts", [1, 17])
def test_partitioning_changes_nothing(reviews_of, products_of, parts):
    reviews = reviews_of(
        *[
            review(user=f"u{i % 9}", item=f"i{i % 7}", rating=float(i % 5 + 1), votes=i % 4,
                   length=i * 11, year=2000 + i % 3, body=f"word{i % 6} other{i % 5}")
            for i in range(200)
        ]
    )
    products = products_of(*[(f"i{i}", i * 20.0, f"b{i % 3}") for i in range(7)])
    for report in (
        lambda r, p: analyses.yearly_trend(r),
        lambda r, p: analyses.votes_by_length(r),
        lambda r, p: analyses.user_frequency(r, min_reviews=23),
        analyses.price_buckets,
        analyses.brand_ranking,
        lambda r, p: analyses.keyword_ranking(r),
    ):
        moved = report(reviews.repartition(parts), products.repartition(parts))
        assert rows(moved) == rows(report(reviews, products))


def test_charts(spark, reviews_of, products_of):
    reviews = reviews_of(
        review(item="a", rating=5.0, votes=2, length=50, body="great mouse"),
        review(item="a", rating=1.0, votes=4, length=400, verified=False, body="broken"),
    )
    products = products_of(("a", 12.0, "B" * 60))
    assert rows(charts.yearly_series(analyses.yearly_trend(reviews))) == [(2012, 2)]
    assert rows(charts.rating_bars(analyses.rating_distribution(reviews))) == [(1.0, 1), (5.0, 1)]
    assert rows(charts.verified_bars(analyses.verified_compare(reviews))) == [
        ("Verified Purchase", 5.0), ("Non Verified Purchase", 1.0)
    ]
    votes = analyses.votes_by_length(reviews)
    assert rows(charts.length_bucket_order(votes)) == [(1, "0-99 chars"), (3, "300-699 chars")]
    heat_map = charts.votes_heat_map(votes)
    assert heat_map.columns[1:] == list(analyses.LENGTH_LABELS)
    assert rows(heat_map) == [(1, None, None, 4.0, None, None), (5, 2.0, None, None, None, None)]
    users = charts.user_group_bars(analyses.user_frequency(reviews))
    assert rows(users) == [("Ordinary User", 3.0, 50.0)]
    prices = analyses.price_buckets(reviews, products)
    assert rows(charts.price_bars(prices)) == [(2, "$10-24.99", 2, 3.0)]
    brands = analyses.brand_ranking(reviews, products, min_reviews=1)
    assert rows(charts.brand_bars(brands)) == [("B" * 45, 2, 3.0)]
    keywords = analyses.keyword_ranking(reviews)
    assert rows(charts.keyword_bars(keywords)) == [
        ("High Rating", 2, "mouse", 1), ("High Rating", 1, "great", 1), ("Low Rating", 1, "broken", 1)
    ]
    assert dict(rows(charts.keyword_weights(keywords))) == {
        "high_rating": {"great": 1, "mouse": 1}, "low_rating": {"broken": 1}
    }
