"""Semi-join reduction, merged sketches and bitmaps, counts of writes, samples, bad lines."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from starmill.operators import profile
from starmill.operators.profile import sample_rows
from starmill.operators.semijoin import reduce_by_keys
from starmill.operators.sketches import (
    RANK_ERROR,
    dense_ids,
    distinct_bitmaps,
    distinct_from,
    merged_quantile,
    quantile_sketches,
    rank_errors,
)
from starmill.plans import analyses, cleaning
from starmill.sources.readers import quarantine_lines
from starmill.sources.schemas import RAW_REVIEWS
from starmill.sources.sql_functions import bucket_functions, register_functions
from tests.conftest import plan, review, rows


def test_reduction_keeps_all_that_join_and_few_others(spark):
    facts = spark.range(20_000).select((F.col("id") % 10_000).alias("k"), F.col("id").alias("v"))
    lookup = spark.range(0, 10_000, 5).select(F.col("id").alias("k"))
    kept = reduce_by_keys(facts, lookup, "k")
    assert kept.join(lookup, "k", "left_semi").count() == 4000
    assert kept.count() < 4000 + 0.05 * 16_000
    assert "Exchange" not in plan(kept).split("Subquery")[0]


def test_a_full_filter_lets_more_pass_and_loses_nothing(spark):
    facts = spark.range(3000).select(F.col("id").alias("k"))
    lookup = spark.range(0, 3000, 3).select(F.col("id").alias("k"))
    kept = reduce_by_keys(facts, lookup, "k", most_bits=64)
    assert kept.join(lookup, "k", "left_semi").count() == 1000


def test_reduction_by_nothing_and_of_missing_keys(spark):
    facts = spark.createDataFrame([("a",), (None,), ("b",)], "k string")
    assert rows(reduce_by_keys(facts, facts.limit(0), "k")) == []
    assert sorted(rows(reduce_by_keys(facts, facts, "k"))) == [("a",), ("b",)]


def test_fewer_rows_reach_the_shuffle_of_the_price_report(spark, reviews_of, products_of):
    """The filter lies below the first aggregation, and the report stays the same."""
    reviews = reviews_of(*[review(item=f"i{i % 500}", rating=float(i % 5 + 1)) for i in range(2000)])
    products = products_of(*[(f"i{i}", 12.0 if i % 10 == 0 else None, "") for i in range(500)])
    reduced = analyses.price_buckets(reviews, products, reduce=True)
    assert rows(reduced) == rows(analyses.price_buckets(reviews, products))
    text = plan(reduced)
    below = text[text.index("partial_count") :]
    assert "getbit" in below
    entering = reduce_by_keys(reviews, products.where("price is not null"), "asin").count()
    assert 200 <= entering < 400


@pytest.fixture
def yearly(spark):
    n = F.col("id")
    return spark.range(20_000).select(
        (n % 3).alias("g"), (n % 7).alias("year"), F.when(n % 11 > 0, (n * n % 9973)).alias("x")
    ).repartition(6)


def test_medians_from_merged_sketches(yearly):
    sketches = quantile_sketches(yearly, ["g"], "year", "x")
    assert sketches.count() == 21
    found = merged_quantile(sketches, ["g"])
    errors = rank_errors(yearly, found, ["g"], "x", 0.5)
    assert all(r["rank_error"] <= RANK_ERROR for r in errors.collect())
    counted = yearly.where("x is not null").groupBy("g").count()
    assert sorted(rows(found.select("g", "n"))) == sorted(rows(counted))
    off = rank_errors(yearly, found.withColumn("value", F.lit(0.0)), ["g"], "x", 0.5)
    assert all(r["rank_error"] > 0.4 for r in off.collect())


def test_dense_ids_have_no_gaps_and_keep_the_order(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 1000 * 13).alias("k")).repartition(9)
    found = rows(dense_ids(df, "k").orderBy("k"))
    assert [i for _, i in found] == list(range(1000))
    missing = spark.createDataFrame([(None,), ("b",), ("a",)], "k string")
    assert sorted(rows(dense_ids(missing, "k"))) == [("a", 0), ("b", 1)]


def test_distinct_counts_from_bitmaps_of_several_buckets(spark):
    n = F.col("id")
    df = spark.range(200_000).select(
        (n % 2).alias("g"), (n % 5).alias("year"), F.when(n % 3 > 0, n % 70_000).alias("k")
    )
    bitmaps = distinct_bitmaps(df, dense_ids(df, "k"), ["g"], "year", "k")
    ours = distinct_from(bitmaps, ["g"], "n").orderBy("g")
    assert rows(ours) == rows(df.groupBy("g").agg(F.count_distinct("k").alias("n")).orderBy("g"))
    assert bitmaps.agg(F.max("bucket")).first()[0] == 3
    part = distinct_from(bitmaps.where("year < 2"), ["g"], "n").orderBy("g")
    assert rows(part) == rows(df.where("year < 2").groupBy("g").agg(F.count_distinct("k")).orderBy("g"))


def test_counts_come_out_of_the_writing_job(spark, tmp_path, monkeypatch):
    raw = spark.createDataFrame(
        [("u", "i", "5", "1"), ("u", "i", "5", "1"), ("u", "i", "x", "1"), (None, "i", "5", "1")],
        "reviewerID string, asin string, overall string, unixReviewTime string",
    ).selectExpr("*", "'' verified", "'t' reviewText", "'s' summary", "'' reviewTime", "'1' vote", "'{' _corrupt_record")
    raw.write.parquet(str(tmp_path / "raw"))

    def scanned(*_):
        raise AssertionError("a second scan")

    monkeypatch.setattr(profile, "clean_counts", scanned)
    counts = cleaning.write_clean_reviews(spark, str(tmp_path / "raw"), str(tmp_path / "clean"))
    assert rows(counts) == [(4, 4, 2, 1, 1)]
    assert plan(counts).count("FileScan parquet") == 1 and "raw" not in plan(counts).split("Location")[-1]


def test_rows_counted_twice_are_noticed(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "raw"))
    raw = spark.newSession().read.parquet(str(tmp_path / "raw"))
    counting = profile.WriteCounts(raw, F.col("id") > 2)
    raw.write.parquet(str(tmp_path / "one"))
    counting._seen = type("Seen", (), {"get": {"raw_rows": 12, "corrupt_rows": 0, "rejected_rows": 5}})()
    written = spark.read.parquet(str(tmp_path / "one"))
    assert rows(counting.counts(written)) == [(10, 0, 3, -3, 10)]


def test_samples_are_the_same_under_any_partitioning(spark):
    df = spark.range(1000).select(F.col("id").alias("a"), F.when(F.col("id") % 3 > 0, "x").alias("b"))
    first = rows(sample_rows(df.repartition(3), ["a", "b"], 7))
    assert first == rows(sample_rows(df.repartition(11), ["a", "b"], 7)) and len(first) == 7
    assert "TakeOrderedAndProject" in plan(sample_rows(df, ["a", "b"], 7))


def test_bad_lines_are_set_aside_with_their_file(spark, tmp_path):
    lines = ['{"reviewerID": "u", "asin": "i"}', '{"reviewerID": "cut', "no json", '{"asin": "j"}', "no json"]
    (tmp_path / "raw.json").write_text("\n".join(lines))
    good, bad = quarantine_lines(
        spark, str(tmp_path / "raw.json"), RAW_REVIEWS, str(tmp_path / "landed"), str(tmp_path / "bad")
    )
    assert sorted(r["line"] for r in bad.collect()) == sorted([lines[1], "no json", "no json"])
    assert {r["raw_file"].rsplit("/", 1)[1] for r in bad.collect()} == {"raw.json"}
    assert sorted(map(repr, rows(good.select("reviewerID", "asin")))) == ["('u', 'i')", "(None, 'j')"]
    assert "_corrupt_record" not in good.columns


def test_sql_functions(spark):
    register_functions(spark)
    found = spark.sql(
        """SELECT parse_votes('1,234'), parse_votes(NULL), parse_price('$1,299.99 - $2'), clean_brand('by  A  B'),
                  length_bucket(100), length_label(99), price_label(NULL), price_bucket(1e9)"""
    )
    assert rows(found) == [(1234, 0, 1299.99, "A B", 2, "0-99 chars", None, 6)]
    words = spark.sql("SELECT word FROM words('Don''t STOP, a café', 3)")
    assert rows(words) == [("don",), ("stop",), ("caf",)]
    for statement in bucket_functions("odd", (1,), ("it's", "more")):
        spark.sql(statement)
    assert rows(spark.sql("SELECT odd_label(0), odd_bucket(1)")) == [("it's", 2)]


def test_sql_reports_run_no_python(spark, sf_dir):
    from starmill.catalog import QUERIES

    for name in ("sql_report_votes", "sql_report_prices", "sql_report_keywords"):
        assert "Python" not in plan(QUERIES[name](spark, sf_dir))
