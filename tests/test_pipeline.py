"""Sources, sinks and the whole pipeline from gzip JSON lines to reports."""

from __future__ import annotations

import gzip
import json
from types import SimpleNamespace

import pytest
from pyspark.errors import AnalysisException

from starmill.plans import pipeline
from starmill.session import materialise, shared_dir
from starmill.sources import readers, writers
from starmill.sources.schemas import RAW_PRODUCTS, RAW_REVIEWS
from tests.conftest import rows


def write_lines(path, records, broken=()):
    with gzip.open(path, "wt", encoding="utf-8") as out:
        for item in records:
            out.write(json.dumps(item) + "\n")
        for line in broken:
            out.write(line + "\n")
    return str(path)


def raw_review(i, **fields):
    base = {
        "reviewerID": f"u{i % 17}", "asin": f"i{i % 6}", "overall": i % 5 + 1.0,
        "verified": i % 3 > 0, "reviewText": f"nice mouse number{i % 4} " * (i % 30),
        "summary": "works great" if i % 2 else "broken cable",
        "unixReviewTime": 1_000_000_000 + i * 1_000_000, "reviewTime": "09 9, 2001",
    }
    if i % 4 == 0:
        base["vote"] = "1,002" if i % 8 else "3"
    return {**base, **fields}


@pytest.fixture(scope="module")
def raw_paths(tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    reviews = [raw_review(i) for i in range(300)]
    dirty = [
        raw_review(1),
        raw_review(1, reviewText="another text"),
        raw_review(400, overall=None),
        raw_review(401, reviewerID=None),
        raw_review(402, overall="4.0", verified="true", unixReviewTime="1355356800", vote=7),
    ]
    products = [
        {"asin": f"i{i}", "title": f"T{i}", "brand": "by Maker" if i % 2 else "Baby Co",
         "price": f"${i}1,0{i}0.50", "also_buy": ["x"]}
        for i in range(5)
    ] + [{"asin": "i5", "title": "no price", "price": "call us"}, {"title": "no item"}]
    return {
        "reviews": write_lines(root / "reviews.json.gz", reviews + dirty, ["{not json", ""]),
        "reviews5": write_lines(root / "reviews5.json.gz", reviews[:200]),
        "products": write_lines(root / "products.json.gz", products),
    }


@pytest.fixture(scope="module")
def finished(spark, raw_paths, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out"))
    return pipeline.run(spark, **raw_paths, out=out)


def report(spark, layout, name):
    return readers.read_result_csv(spark, layout.report(name))


def test_json_lines_under_a_schema(spark, raw_paths):
    raw = readers.read_json_lines(spark, raw_paths["reviews"], RAW_REVIEWS)
    kept = {r["_corrupt_record"] for r in raw.collect()}
    assert kept == {None, "{not json"}
    mixed = [r for r in raw.collect() if r["vote"] == "7"]
    assert [(r["overall"], r["verified"]) for r in mixed] == [("4.0", "true")]
    products = readers.read_json_lines(spark, raw_paths["products"], RAW_PRODUCTS)
    assert products.where("asin = 'i0'").first()["also_buy"] == ["x"]


def test_counts_before_and_after_cleaning(spark, finished):
    counts = rows(report(spark, finished, f"00_counts_{pipeline.REVIEWS}"))
    assert counts == [(306, 1, 3, 2, 301)]
    assert rows(report(spark, finished, f"00_counts_{pipeline.PRODUCTS}")) == [(7, 0, 1, 0, 6)]
    clean = readers.read_table(spark, finished.clean(pipeline.REVIEWS))
    assert clean.count() == 301


def test_profile(spark, finished):
    profile = report(spark, finished, f"00_profile_{pipeline.PRODUCTS}").collect()
    assert profile[0]["column_name"] == "asin" and profile[0]["row_count"] == 7
    assert report(spark, finished, f"00_sample_{pipeline.REVIEWS}").count() == 5


def test_totals_agree_across_reports(spark, finished):
    def total(name, column="review_count"):
        return sum(r[column] for r in report(spark, finished, name).collect())

    assert total(pipeline.DISTRIBUTION) == total(pipeline.VOTES) == 301
    assert total(pipeline.TREND) == total(pipeline.VERIFIED) == 301
    verified = report(spark, finished, pipeline.VERIFIED).collect()
    assert total(pipeline.TREND, "verified_review_count") == verified[0]["review_count"]
    assert abs(total(pipeline.DISTRIBUTION, "review_pct") - 100) < 0.05
    assert total(pipeline.USERS) == 200 and total(pipeline.USERS, "user_count") == 17


def test_rankings(spark, finished):
    brands = report(spark, finished, pipeline.BRANDS).collect()
    counts = [r["review_count"] for r in brands]
    assert counts == sorted(counts, reverse=True) and min(counts) >= 20
    assert {r["brand"] for r in brands} == {"Maker", "Baby Co", "Unknown"}
    keywords = report(spark, finished, pipeline.KEYWORDS).collect()
    assert {r["sentiment_group"] for r in keywords} == {"high_rating", "low_rating"}
    assert [r["keyword_rank"] for r in keywords[:4]] == [1, 2, 3, 4]


def test_prices_keep_their_thousands(spark, finished):
    prices = report(spark, finished, pipeline.PRICES).collect()
    assert [r["price_bucket"] for r in prices] == ["$100+"]
    assert prices[0]["product_count"] == 5


def test_model_reports(spark, finished):
    metrics = dict(rows(report(spark, finished, pipeline.METRICS)))
    assert int(metrics["train_rows"]) + int(metrics["test_rows"]) == 301
    assert report(spark, finished, pipeline.COEFFICIENTS).count() == 6


def test_chart_feeds(spark, finished):
    weights = readers.read_table(spark, finished.chart("08_keyword_weights")).collect()
    assert {r["sentiment_group"] for r in weights} == {"high_rating", "low_rating"}
    heat_map = readers.read_table(
        spark, finished.chart("04_helpful_votes_by_rating_and_length")
    )
    assert heat_map.count() == 5


def test_clean_tables_answer_sql(spark, finished):
    pipeline.open_clean(spark, finished)
    joined = spark.sql(
        "SELECT count(*) FROM reviews_clean JOIN meta_clean USING (asin) WHERE price IS NOT NULL"
    )
    assert joined.first()[0] > 200


def test_published_parsing_on_request(spark, raw_paths, tmp_path):
    layout = pipeline.Layout(str(tmp_path))
    paths = {pipeline.PRODUCTS: raw_paths["products"]}
    raw = pipeline.land(spark, paths, layout)
    pipeline.clean(raw, layout, pipeline.Options(legacy_parsing=True))
    products = readers.read_table(spark, layout.clean(pipeline.PRODUCTS))
    assert rows(products.where("asin = 'i2'").select("brand", "price")) == [("BaCo", 21.0)]


def test_reports_are_one_csv_and_one_parquet_file(spark, tmp_path):
    df = spark.range(100).repartition(7).selectExpr("id", "id * 2 AS twice")
    csv, table = str(tmp_path / "csv"), str(tmp_path / "table")
    writers.write_report(df, csv, table, one_file=True)
    assert len(list((tmp_path / "csv").glob("*.csv"))) == 1
    assert readers.read_result_csv(spark, csv, "id bigint, twice bigint").count() == 100
    assert readers.read_table(spark, table).count() == 100
    assert not df.is_cached


def test_other_results_stay_parallel_and_whole(spark, tmp_path):
    writers.write_report(spark.range(100).repartition(7), str(tmp_path / "csv"))
    assert len(list((tmp_path / "csv").glob("*.csv"))) > 1
    assert readers.read_result_csv(spark, str(tmp_path / "csv")).count() == 100


def test_persisted_lets_go_after_an_error(spark):
    df = spark.range(3)
    with pytest.raises(RuntimeError), writers.persisted(df):
        raise RuntimeError
    assert not df.is_cached


def test_missing_results_raise(spark, tmp_path):
    with pytest.raises(AnalysisException):
        readers.read_result_csv(spark, str(tmp_path / "nothing"))


def test_intermediate_tables_go_to_the_shared_folder(spark):
    copy = materialise(spark.range(10), "numbers")
    assert copy.count() == 10
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_dir(spark) == configured.rstrip("/")
        assert configured in copy.inputFiles()[0]


def test_a_cluster_must_name_its_shared_folder():
    class Conf:
        def get(self, key, default):
            return default

    cluster = SimpleNamespace(conf=Conf(), sparkContext=SimpleNamespace(master="yarn"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(cluster)


def test_command_line_arguments(raw_paths, tmp_path, monkeypatch, spark):
    seen = {}
    monkeypatch.setattr(pipeline, "build_session", lambda name: type("S", (), {"stop": lambda s: None})())
    monkeypatch.setattr(pipeline, "run", lambda *args: seen.update(stages=args[-1], options=args[-2], out=args[-3]))
    pipeline.main(
        ["--reviews", "r", "--reviews5", "r5", "--products", "p", "--out", "o",
         "--legacy-parsing", "--stages", "reports,charts"]
    )
    assert seen == {
        "options": pipeline.Options(True), "out": "o", "stages": ["reports", "charts"]
    }


def test_unknown_stages_are_refused(spark):
    with pytest.raises(ValueError, match="no such stages"):
        pipeline.run(spark, "r", "r5", "p", "o", stages=["polish"])
