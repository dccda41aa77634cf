"""Cleaning raw records, including the dirty ones."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from starmill.plans import cleaning
from starmill.sources.schemas import RAW_PRODUCTS, RAW_REVIEWS
from tests.conftest import plan, rows

REVIEW_FIELDS = [field.split()[0] for field in RAW_REVIEWS.split(",")]


@pytest.fixture
def raw_reviews_of(spark):
    def build(*records):
        complete = [tuple(r.get(name) for name in REVIEW_FIELDS) for r in records]
        return spark.createDataFrame(complete, RAW_REVIEWS)

    return build


def record(**fields):
    base = dict(reviewerID="u", asin="i", overall="5.0", verified="true", reviewText="text",
                summary="s", unixReviewTime="1355356800", vote="1,234")
    return {**base, **fields}


def test_clean_columns_and_values(raw_reviews_of):
    clean = cleaning.clean_reviews(raw_reviews_of(record()))
    assert clean.first().asDict() == {
        "reviewerID": "u",
        "asin": "i",
        "rating": 5.0,
        "verified": True,
        "reviewText": "text",
        "summary": "s",
        "unix_time": 1355356800,
        "helpful_votes": 1234,
        "review_date": datetime.date(2012, 12, 13),
        "review_year": 2012,
        "review_month": 12,
        "review_length": 4,
        "has_review_text": 1,
    }
    kinds = {f.name: f.dataType.simpleString() for f in clean.schema}
    assert kinds["unix_time"] == "bigint" and kinds["helpful_votes"] == "int"


def test_incomplete_reviews_are_dropped(raw_reviews_of):
    raw = raw_reviews_of(
        record(),
        record(reviewerID=None),
        record(asin=None),
        record(overall=None),
        record(overall="five"),
        {"_corrupt_record": "{broken"},
    )
    assert cleaning.clean_reviews(raw).count() == 1
    assert rows(cleaning.review_counts(raw, cleaning.clean_reviews(raw))) == [(6, 1, 5, 0, 1)]


def test_missing_values(raw_reviews_of):
    raw = raw_reviews_of(
        record(reviewText=None, vote=None, unixReviewTime=None, verified=None, summary=None)
    )
    clean = cleaning.clean_reviews(raw).first()
    assert (clean.review_length, clean.has_review_text, clean.helpful_votes) == (0, 0, 0)
    assert (clean.review_date, clean.review_year, clean.verified) == (None, None, None)


def test_repeated_reviews_keep_one_and_the_same(raw_reviews_of):
    raw = raw_reviews_of(
        *[record(reviewText=text) for text in ("zz", "aa", None, "mm")],
        record(unixReviewTime=None),
        record(unixReviewTime=None, reviewText="b"),
        record(unixReviewTime="7"),
    )
    for parts in (1, 5):
        clean = cleaning.clean_reviews(raw.repartition(parts))
        assert sorted(rows(clean.select("unix_time", "reviewText")), key=repr) == [
            (1355356800, "aa"), (7, "text"), (None, "text")
        ]
    assert rows(cleaning.review_counts(raw, cleaning.clean_reviews(raw))) == [(7, 0, 0, 4, 3)]


def test_a_third_of_all_rows_on_one_key(spark, raw_reviews_of):
    one = raw_reviews_of(record())
    copies = one.crossJoin(spark.range(500)).withColumn("summary", F.col("id").cast("string"))
    others = one.crossJoin(spark.range(1000)).withColumn("asin", F.col("id").cast("string"))
    raw = copies.unionByName(others).drop("id").repartition(7)
    clean = cleaning.clean_reviews(raw)
    assert clean.count() == 1001
    assert rows(clean.where("asin = 'i'").select("summary")) == [("76",)]


def test_cleaning_shuffles_once_after_trimming(raw_reviews_of):
    text = plan(cleaning.clean_reviews(raw_reviews_of(record())))
    assert text.count("Exchange hashpartitioning") == 1
    assert "row_number(), 1, Partial" in text
    assert "Python" not in text


def test_clean_products(spark):
    data = [
        ("a", "T", "by\n  Zenith", "$1,299.99", ["x"], None, None),
        ("b", "T", None, "12.5", None, None, None),
        ("b", "S", "Baby Toys", "$5 - $9", None, ["y"], None),
        (None, "T", "B", "$1", None, None, None),
    ]
    raw = spark.createDataFrame(data, RAW_PRODUCTS)
    clean = cleaning.clean_products(raw)
    assert clean.columns == [
        "asin", "title", "price_raw", "also_buy", "also_view", "brand", "price"
    ]
    assert sorted(rows(clean)) == [
        ("a", "T", "$1,299.99", ["x"], None, "Zenith", 1299.99),
        ("b", "S", "$5 - $9", None, ["y"], "Baby Toys", 5.0),
    ]
    legacy = cleaning.clean_products(raw, legacy=True).orderBy("asin")
    assert rows(legacy.select("brand", "price")) == [("Zenith", 1.0), ("BaToys", 5.0)]
    assert rows(cleaning.product_counts(raw, clean)) == [(4, 0, 1, 1, 2)]
