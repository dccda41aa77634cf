"""The whole batch job: land, profile, clean, analyse, chart feeds, model.

    python -m starmill.plans.pipeline --reviews R.json.gz --reviews5 R5.json.gz \\
        --products P.json.gz --out /some/shared/folder
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from starmill.operators.profile import profile_table, sample_rows
from starmill.plans import analyses, charts, cleaning, helpful_model
from starmill.session import build_session
from starmill.sources.readers import land_json_lines, read_table, register_views
from starmill.sources.schemas import RAW_PRODUCTS, RAW_REVIEWS
from starmill.sources.writers import write_report, write_table

# Names of the clean tables and of the published results.
REVIEWS, CORE_REVIEWS, PRODUCTS = "reviews_clean", "reviews5_clean", "meta_clean"
TREND = "01_yearly_review_trend"
DISTRIBUTION = "02_rating_distribution"
VERIFIED = "03_verified_rating_difference"
VOTES = "04_helpful_votes_relationship"
USERS = "05_user_frequency_behavior_reviews5"
PRICES = "06_price_bucket_rating_reviews"
BRANDS = "07_brand_review_rating_ranking"
KEYWORDS = "08_high_low_rating_keywords"
FEATURES = "helpful_features"
METRICS = "09_helpful_prediction_metrics"
COEFFICIENTS = "09_helpful_prediction_coefficients"

REVIEW_SAMPLE = ["reviewerID", "asin", "overall", "verified", "reviewTime", "summary"]
PRODUCT_SAMPLE = ["asin", "title", "brand", "price"]


@dataclass(frozen=True)
class Options:
    """``legacy_parsing`` reproduces the published parsing of prices and brands."""

    legacy_parsing: bool = False


@dataclass(frozen=True)
class Layout:
    """Where the pipeline keeps its tables below one root folder."""

    root: str

    def raw(self, name: str) -> str:
        return f"{self.root}/raw/{name}"

    def clean(self, name: str) -> str:
        return f"{self.root}/clean/{name}"

    def report(self, name: str) -> str:
        return f"{self.root}/outputs/tables/{name}"

    def result(self, name: str) -> str:
        return f"{self.root}/outputs/results/{name}"

    def chart(self, name: str) -> str:
        return f"{self.root}/outputs/charts/{name}"


def land(spark: SparkSession, raw_paths: dict[str, str], layout: Layout) -> dict[str, DataFrame]:
    """Parse the raw JSON lines once each."""
    return {
        name: land_json_lines(
            spark, path, RAW_PRODUCTS if name == PRODUCTS else RAW_REVIEWS, layout.raw(name)
        )
        for name, path in raw_paths.items()
    }


def profile(raw: dict[str, DataFrame], layout: Layout) -> None:
    """Schema and row count of every raw table, and a few rows to look at."""
    for name, df in raw.items():
        columns = PRODUCT_SAMPLE if name == PRODUCTS else REVIEW_SAMPLE
        write_report(profile_table(df, name), layout.report(f"00_profile_{name}"), one_file=True)
        write_report(sample_rows(df, columns), layout.report(f"00_sample_{name}"), one_file=True)


def clean(raw: dict[str, DataFrame], layout: Layout, options: Options) -> None:
    """Write the clean tables and how many rows each lost."""
    for name, df in raw.items():
        spark, paths = df.sparkSession, (layout.raw(name), layout.clean(name))
        counts = (
            cleaning.write_clean_products(spark, *paths, options.legacy_parsing)
            if name == PRODUCTS
            else cleaning.write_clean_reviews(spark, *paths)
        )
        write_report(counts, layout.report(f"00_counts_{name}"), one_file=True)


def open_clean(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    """The clean tables, also registered as views for ``spark.sql``."""
    names = (REVIEWS, CORE_REVIEWS, PRODUCTS)
    tables = {name: read_table(spark, layout.clean(name)) for name in names}
    register_views(tables)
    return tables


def reports(tables: dict[str, DataFrame], options: Options) -> dict[str, DataFrame]:
    """The eight analyses under their published names."""
    reviews, core, products = (tables[n] for n in (REVIEWS, CORE_REVIEWS, PRODUCTS))
    return {
        TREND: analyses.yearly_trend(reviews),
        DISTRIBUTION: analyses.rating_distribution(reviews),
        VERIFIED: analyses.verified_compare(reviews),
        VOTES: analyses.votes_by_length(reviews),
        USERS: analyses.user_frequency(core),
        PRICES: analyses.price_buckets(reviews, products),
        BRANDS: analyses.brand_ranking(reviews, products),
        KEYWORDS: analyses.keyword_ranking(reviews),
    }


def chart_feeds(results: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Chart tables from finished results. The keyword weights are a map, which CSV
    cannot hold, so every feed is written as Parquet."""
    return {
        "01_yearly_review_count_trend": charts.yearly_series(results[TREND]),
        "02_rating_distribution": charts.rating_bars(results[DISTRIBUTION]),
        "03_verified_purchase_avg_rating": charts.verified_bars(results[VERIFIED]),
        "04_helpful_votes_by_rating_and_length": charts.votes_heat_map(results[VOTES]),
        "05_user_frequency_rating_behavior": charts.user_group_bars(results[USERS]),
        "06_price_bucket_reviews_and_rating": charts.price_bars(results[PRICES]),
        "07_top_brands_by_review_count": charts.brand_bars(results[BRANDS]),
        "08_high_low_rating_top_keywords": charts.keyword_bars(results[KEYWORDS]),
        "08_keyword_weights": charts.keyword_weights(results[KEYWORDS]),
    }


STAGES = ("land", "profile", "clean", "reports", "charts", "model")


def run(
    spark: SparkSession,
    reviews: str,
    reviews5: str,
    products: str,
    out: str,
    options: Options = Options(),
    stages: Sequence[str] = STAGES,
) -> Layout:
    """The named stages in order. Each reads the tables that earlier ones left below
    ``out``, so a run can be resumed with the stages that are missing."""
    if unknown := set(stages) - set(STAGES):
        raise ValueError(f"no such stages: {sorted(unknown)}")
    layout = Layout(out.rstrip("/"))
    paths = {REVIEWS: reviews, CORE_REVIEWS: reviews5, PRODUCTS: products}
    if "land" in stages:
        land(spark, paths, layout)
    raw = {name: read_table(spark, layout.raw(name)) for name in paths} if (
        {"profile", "clean"} & set(stages)
    ) else {}
    if "profile" in stages:
        profile(raw, layout)
    if "clean" in stages:
        clean(raw, layout, options)
    if "reports" in stages:
        # Years, scores, buckets and first rows of rankings: bounded by definition.
        for name, df in reports(open_clean(spark, layout), options).items():
            write_report(df, layout.report(name), layout.result(name), one_file=True)
    if "charts" in stages:
        names = (TREND, DISTRIBUTION, VERIFIED, VOTES, USERS, PRICES, BRANDS, KEYWORDS)
        results = {name: read_table(spark, layout.result(name)) for name in names}
        for name, df in chart_feeds(results).items():
            write_table(df.coalesce(1), layout.chart(name))
    if "model" in stages:
        tables = open_clean(spark, layout)
        trained = helpful_model.train_model(
            tables[REVIEWS], tables[PRODUCTS], table_path=layout.clean(FEATURES)
        )
        write_report(trained.metrics(), layout.report(METRICS), one_file=True)
        write_report(trained.coefficients(), layout.report(COEFFICIENTS), one_file=True)
    return layout


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Review analytics from raw JSON lines")
    parser.add_argument("--reviews", required=True, help="raw reviews, JSON lines")
    parser.add_argument("--reviews5", required=True, help="raw 5-core reviews, JSON lines")
    parser.add_argument("--products", required=True, help="raw product metadata, JSON lines")
    parser.add_argument("--out", required=True, help="root folder for all tables")
    parser.add_argument("--legacy-parsing", action="store_true", help="published price and brand parsing")
    parser.add_argument("--stages", default=",".join(STAGES), help="stages to run, by comma")
    args = parser.parse_args(argv)
    spark = build_session("starmill")
    options, stages = Options(args.legacy_parsing), args.stages.split(",")
    run(spark, args.reviews, args.reviews5, args.products, args.out, options, stages)
    spark.stop()


if __name__ == "__main__":
    main()
