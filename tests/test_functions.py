"""Scalar functions on the dirty values they exist for."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from starmill.functions import buckets, parsing, text


def values(spark, column, inputs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(column.alias("y")).collect()]


def test_counts_from_text(spark):
    inputs = ["1,234", None, "abc", "", "7", "12.0", "1,234,567", "99999999999", " 5 "]
    expected = [1234, 0, None, None, 7, 12, 1234567, None, 5]
    assert values(spark, parsing.parse_count(F.col("x")), inputs) == expected


def test_prices_from_text(spark):
    inputs = ["$19.99", "$1,299.99", "$5 - $9", "12.5", "", None, "was $3", "$", "$12,"]
    price = parsing.parse_price(F.col("x"))
    assert values(spark, price, inputs) == [19.99, 1299.99, 5.0, None, None, None, 3.0, None, 12.0]


def test_legacy_prices_stop_at_a_comma(spark):
    price = parsing.parse_price(F.col("x"), legacy=True)
    assert values(spark, price, ["$19.99", "$1,299.99", "$5 - $9"]) == [19.99, 1.0, 5.0]


def test_labels(spark):
    inputs = ["by Acme", "by\n  Zenith", "Baby Toys", "Ruby  Red", None, " "]
    label = parsing.clean_label(F.col("x"))
    assert values(spark, label, inputs) == ["Acme", "Zenith", "Baby Toys", "Ruby Red", "", " "]


def test_legacy_labels_lose_by_anywhere(spark):
    label = parsing.clean_label(F.col("x"), legacy=True)
    assert values(spark, label, ["by Acme", "Baby Toys", "Ruby Red"]) == [
        "Acme",
        "Baby Toys".replace("by ", ""),
        "RuRed",
    ]


def test_blank_values_get_a_default(spark):
    label = parsing.blank_to_default(F.col("x"), "Unknown")
    assert values(spark, label, [None, "", "  ", " Zenith "]) == ["Unknown"] * 3 + ["Zenith"]


def test_dates_are_utc_in_any_session_zone(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "America/New_York"
    inputs = [1355356800, 1355356799, 0, -1, None, 2**62]
    day = datetime.date
    assert values(spark, parsing.utc_date(F.col("x")), inputs[:5], "bigint") == [
        day(2012, 12, 13), day(2012, 12, 12), day(1970, 1, 1), day(1969, 12, 31), None
    ]
    assert values(spark, parsing.utc_date(F.col("x")), inputs[5:], "bigint") == [None]


def test_text_length_counts_characters(spark):
    assert values(spark, text.text_length(F.col("x")), [None, "", "don't", "\U0001f600"]) == [
        0, 0, 5, 1
    ]


def test_words_end_at_apostrophes_and_other_letters(spark):
    inputs = ["don't stop", "café x", "  A-1 ", "", "Kelvin İst"]
    words = values(spark, text.word_array(F.col("x")), inputs)
    assert words == [["don", "t", "stop"], ["caf", "x"], ["A", "1"], [], ["elvin", "st"]]
    assert values(spark, text.word_array(F.col("x"), min_chars=3), inputs[:1]) == [["don", "stop"]]


def test_word_array_equals_the_two_pass_form(spark):
    inputs = ["One, two;three", "...", "a  b", "Überüber 42", "x\ny\tz", "Kİ"]
    slow = text.split_words(text.normalize_text(F.col("x")))
    slow_words = [[w for w in ws if w] for ws in values(spark, slow, inputs)]
    fast = values(spark, text.word_array(F.col("x")), inputs)
    assert [[w.lower() for w in ws] for ws in fast] == slow_words


def test_other_alphabets_through_the_pattern(spark):
    words = text.word_array(F.col("x"), r"\p{L}")
    assert values(spark, words, ["café über 7"]) == [["café", "über"]]


def test_split_words_keeps_empty_edges(spark):
    split = text.split_words(text.normalize_text(F.col("x")))
    assert values(spark, split, ["Don't!"]) == [["don", "t", ""]]


def test_headline_and_body_are_joined(spark):
    joined = text.join_texts(F.lit("head"), F.col("x"))
    assert values(spark, joined, ["body", None]) == ["head body", "head "]


def test_keywords_are_no_numbers_and_no_stop_words(spark):
    keyword = text.is_keyword(F.col("x"))
    assert values(spark, keyword, ["123", "12a", "the", "mouse"]) == [False, True, False, True]
    assert len(set(text.STOP_WORDS)) == len(text.STOP_WORDS) == 107


def test_labels_for_charts(spark):
    assert values(spark, text.title_label(F.col("x")), ["high_rating"]) == ["High Rating"]
    assert values(spark, text.short_label(F.col("x")), ["x" * 60]) == ["x" * 45]


def test_buckets_end_before_their_edge_and_keep_null(spark):
    order = buckets.bucket_order(F.col("x"), buckets.LENGTH_EDGES)
    inputs = [0, 99, 100, 1499, 1500, None]
    assert values(spark, order, inputs, "int") == [1, 1, 2, 4, 5, None]
    label = buckets.bucket_label(order, buckets.LENGTH_LABELS, buckets.LENGTH_EDGES)
    assert values(spark, label, inputs, "int")[::5] == ["0-99 chars", None]


def test_ratio_is_decimal_half_up(spark):
    ratio = buckets.scaled_ratio(F.col("x"), F.lit(8).cast("bigint"), "1.0", 2)
    assert values(spark, ratio, [1, 3, 0], "bigint") == [0.13, 0.38, 0.0]


@pytest.mark.parametrize(
    ("inputs", "expected"), [([1, 2, 3, 4], 2.0), ([7], 7.0), ([1, 1, 9], 1.0), ([None], None)]
)
def test_median_is_a_value_of_the_data(spark, inputs, expected):
    df = spark.createDataFrame([(v,) for v in inputs], "x int")
    assert df.agg(buckets.median_value("x").alias("m")).first()["m"] == expected
