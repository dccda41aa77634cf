"""Reviews, products and raw records derived from the test tables.

No review table is provided, so each frame here plays its part: whole tables, with the
review columns computed from theirs. Every Spark frame has its SQL twin next to it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Order lines as reviews: the quantity gives a score of 1 to 5; flag "N" is an unknown
# verification; the last line number has unknown votes; early lines have no year.
def line_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.when(F.col("l_returnflag") == "A", True).when(F.col("l_returnflag") == "R", False)
    shipped = F.col("l_shipdate")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("reviewerID"),
        F.col("l_partkey").alias("asin"),
        F.col("l_orderkey").alias("unix_time"),
        F.floor((F.col("l_quantity") - 1) / 10 + 1).cast("double").alias("rating"),
        flag.alias("verified"),
        (F.nullif(F.col("l_linenumber"), F.lit(7)) - 1).alias("helpful_votes"),
        F.floor(F.col("l_extendedprice") / 50).cast("int").alias("review_length"),
        F.when(shipped >= F.lit("1995-03-01"), F.year(shipped)).alias("review_year"),
    )


LINE_REVIEWS = """
    SELECT l_suppkey AS "reviewerID", l_partkey AS asin, l_orderkey AS unix_time,
           CAST(floor((l_quantity - 1) / 10 + 1) AS DOUBLE) AS rating,
           CASE l_returnflag WHEN 'A' THEN true WHEN 'R' THEN false END AS verified,
           NULLIF(l_linenumber, 7) - 1 AS helpful_votes,
           CAST(floor(l_extendedprice / 50) AS INTEGER) AS review_length,
           CASE WHEN l_shipdate >= TIMESTAMP '1995-03-01'
                THEN CAST(year(l_shipdate) AS INTEGER) END AS review_year
    FROM lineitem
"""


# Parts as products: large ones have no price, small ones a blank brand, one size none.
def part_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("asin"),
        F.when(size <= 45, F.col("p_retailprice")).alias("price"),
        F.when(size == 50, None)
        .when(size < 5, F.lit("  "))
        .otherwise(F.concat(F.lit(" "), "p_brand"))
        .alias("brand"),
    )


PART_PRODUCTS = """
    SELECT p_partkey AS asin, CASE WHEN p_size <= 45 THEN p_retailprice END AS price,
           CASE WHEN p_size = 50 THEN NULL WHEN p_size < 5 THEN '  '
                ELSE ' ' || p_brand END AS brand
    FROM part
"""

PART_PRICE_EDGES = (920, 940, 960, 980)
PART_PRICE_LABELS = ("900-919", "920-939", "940-959", "960-979", "980+")


# Orders as reviews by customers, who have from one to some 25 of them.
def order_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("o_totalprice")
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("reviewerID"),
        F.col("o_orderkey").alias("asin"),
        F.when(F.col("o_orderstatus") != "P", F.floor(price / 100_000 + 1))
        .cast("double")
        .alias("rating"),
        F.month("o_orderdate").alias("helpful_votes"),
        F.floor(price / 250).cast("int").alias("review_length"),
    )


ORDER_REVIEWS = """
    SELECT o_custkey AS "reviewerID", o_orderkey AS asin,
           CASE WHEN o_orderstatus <> 'P'
                THEN CAST(floor(o_totalprice / 100000 + 1) AS DOUBLE) END AS rating,
           CAST(month(o_orderdate) AS INTEGER) AS helpful_votes,
           CAST(floor(o_totalprice / 250) AS INTEGER) AS review_length
    FROM orders
"""


# Documents as reviews with text: the length gives a score of 1 to 5, the source is the
# headline.
def document_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("reviewerID"),
        (F.col("n_chars") % 5 + 1).cast("double").alias("rating"),
        F.col("source").alias("summary"),
        F.col("text").alias("reviewText"),
    )


DOCUMENT_REVIEWS = """
    SELECT doc_id AS "reviewerID", CAST(n_chars % 5 + 1 AS DOUBLE) AS rating,
           source AS summary, text AS "reviewText"
    FROM documents
"""


# Documents as raw review records, every scalar as text and with the usual dirt:
# missing reviewers, scores that are no number or far beyond one, unknown flags, thousands commas, votes that are no number, missing
# texts, and several records of one (reviewer, item, time).
DIRTY_SCORES = ("NaN", "Infinity", "1e300", "-Infinity")


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    n_chars, lang, source = F.col("n_chars"), F.col("lang"), F.col("source")
    days = F.floor(n_chars / 400)
    dirty = F.array(*[F.lit(x) for x in DIRTY_SCORES])
    return table(spark, sf_dir, "documents").select(
        F.nullif(source, F.lit("src3")).alias("reviewerID"),
        F.concat(F.lit("item-"), lang).alias("asin"),
        F.when(source == "src11", F.element_at(dirty, (n_chars % 4 + 1).cast("int")))
        .when(n_chars >= 200, (n_chars % 5 + 1).cast("string"))
        .otherwise(F.lit("n/a"))
        .alias("overall"),
        F.when(lang == "en", "true").when(lang == "fr", "false").alias("verified"),
        F.when(n_chars >= 300, F.col("text")).alias("reviewText"),
        F.concat_ws(" ", lang, source).alias("summary"),
        F.when(source != "src7", (days * 86_400 + 1_355_356_799).cast("string")).alias(
            "unixReviewTime"
        ),
        F.when(source == "src5", "none")
        .when(lang != "de", F.format_number("n_chars", 0))
        .alias("vote"),
    )


RAW_REVIEWS = """
    SELECT NULLIF(source, 'src3') AS "reviewerID", 'item-' || lang AS asin,
           CASE WHEN source = 'src11'
                THEN ['NaN', 'Infinity', '1e300', '-Infinity'][n_chars % 4 + 1]
                WHEN n_chars >= 200 THEN CAST(n_chars % 5 + 1 AS VARCHAR)
                ELSE 'n/a' END AS overall,
           CASE lang WHEN 'en' THEN 'true' WHEN 'fr' THEN 'false' END AS verified,
           CASE WHEN n_chars >= 300 THEN text END AS "reviewText",
           concat_ws(' ', lang, source) AS summary,
           CASE WHEN source <> 'src7'
                THEN CAST(n_chars // 400 * 86400 + 1355356799 AS VARCHAR) END
               AS "unixReviewTime",
           CASE WHEN source = 'src5' THEN 'none'
                WHEN lang <> 'de' THEN format('{:,}', n_chars) END AS vote
    FROM documents
"""


# Parts as raw product records: two per item, brands with a "by" in front or inside,
# prices with and without dollar sign or thousands comma.
def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    size, brand = F.col("p_size"), F.col("p_brand")
    amount = F.format_number(F.col("p_retailprice") * size, 2)
    return table(spark, sf_dir, "part").select(
        F.when(F.col("p_partkey") > 10, F.concat(F.lit("P"), F.floor(F.col("p_partkey") / 2)))
        .alias("asin"),
        F.col("p_name").alias("title"),
        F.when(size > 40, F.concat(F.lit("by\n  "), brand))
        .when(size > 30, F.concat(F.lit("Ruby  Red "), brand))
        .when(size > 5, brand)
        .alias("brand"),
        F.when(size > 45, amount)
        .when(size > 40, F.concat(F.lit("from $"), amount, F.lit(" - $99999.99")))
        .when(size > 2, F.concat(F.lit("$"), amount))
        .alias("price"),
        F.split("p_name", " ").alias("also_buy"),
        F.array(brand).alias("also_view"),
    )


RAW_PRODUCTS = r"""
    SELECT CASE WHEN p_partkey > 10 THEN 'P' || CAST(p_partkey // 2 AS VARCHAR) END AS asin,
           p_name AS title,
           CASE WHEN p_size > 40 THEN 'by' || chr(10) || '  ' || p_brand
                WHEN p_size > 30 THEN 'Ruby  Red ' || p_brand
                WHEN p_size > 5 THEN p_brand END AS brand,
           CASE WHEN p_size > 45 THEN format('{:,.2f}', p_retailprice * p_size)
                WHEN p_size > 40
                THEN 'from $' || format('{:,.2f}', p_retailprice * p_size) || ' - $99999.99'
                WHEN p_size > 2 THEN '$' || format('{:,.2f}', p_retailprice * p_size)
                END AS price,
           string_split(p_name, ' ') AS also_buy, [p_brand] AS also_view
    FROM part
"""
