"""The cleaning jobs over raw records derived from documents and parts."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from starmill.catalog.bindings import (
    RAW_PRODUCTS,
    RAW_REVIEWS,
    raw_products,
    raw_reviews,
    table,
)
from starmill.catalog.registry import query
from starmill.operators.dedup import dedup_by_key
from starmill.plans import cleaning
from starmill.session import shared_dir
from starmill.sources.writers import write_table

TYPED_REVIEWS = f"""
    SELECT "reviewerID", asin,
           CASE WHEN isfinite(TRY_CAST(overall AS DOUBLE)) THEN TRY_CAST(overall AS DOUBLE) END
               AS rating,
           CAST(verified AS BOOLEAN) AS verified, "reviewText", summary,
           CAST("unixReviewTime" AS BIGINT) AS unix_time,
           TRY_CAST(replace(COALESCE(vote, '0'), ',', '') AS INTEGER) AS helpful_votes
    FROM ({RAW_REVIEWS})
"""

CLEAN_REVIEWS = f"""
    SELECT * EXCLUDE (rn, day), CAST(day AS DATE) AS review_date,
           CAST(year(day) AS INTEGER) AS review_year,
           CAST(month(day) AS INTEGER) AS review_month,
           CAST(length(COALESCE("reviewText", '')) AS INTEGER) AS review_length,
           CASE WHEN length(COALESCE("reviewText", '')) > 0 THEN 1 ELSE 0 END AS has_review_text
    FROM (SELECT *, make_timestamp(unix_time * 1000000) AS day,
                 row_number() OVER (
                     PARTITION BY "reviewerID", asin, unix_time
                     ORDER BY md5(concat_ws('|', COALESCE("reviewText", ''), COALESCE(summary, ''))),
                              rating NULLS LAST, verified NULLS LAST, "reviewText" NULLS LAST,
                              summary NULLS LAST, helpful_votes NULLS LAST) AS rn
          FROM ({TYPED_REVIEWS})
          WHERE "reviewerID" IS NOT NULL AND asin IS NOT NULL AND rating IS NOT NULL)
    WHERE rn = 1
"""


@query("clean_reviews", CLEAN_REVIEWS)
def clean_reviews(spark, sf_dir):
    return cleaning.clean_reviews(raw_reviews(spark, sf_dir))


CLEAN_PRODUCTS = r"""
    SELECT asin, title, price AS price_raw, array_to_string(also_buy, ',') AS also_buy,
           array_to_string(also_view, ',') AS also_view,
           regexp_replace(regexp_replace(COALESCE(brand, ''), '{brand}', '', 'g'),
                          '\s+', ' ', 'g') AS brand,
           TRY_CAST(replace(regexp_extract(price, '{price}', 1), ',', '') AS DOUBLE) AS price
    FROM (SELECT *, row_number() OVER (
                        PARTITION BY asin
                        ORDER BY md5(concat_ws('|', COALESCE(title, ''), COALESCE(brand, ''),
                                               COALESCE(price, ''))),
                                 title NULLS LAST, brand NULLS LAST, price NULLS LAST,
                                 also_buy NULLS LAST, also_view NULLS LAST) AS rn
          FROM ({source}) WHERE asin IS NOT NULL)
    WHERE rn = 1
"""


@query(
    "clean_meta",
    CLEAN_PRODUCTS.format(
        brand=r"^\s*by\s+", price=r"\$([0-9][0-9,]*(?:\.[0-9]+)?)", source=RAW_PRODUCTS
    ),
)
def clean_meta(spark, sf_dir):
    return _with_text_arrays(cleaning.clean_products(raw_products(spark, sf_dir)))


@query(
    "clean_meta_legacy",
    CLEAN_PRODUCTS.format(
        brand=r"by\s+", price=r"\$([0-9]+(?:\.[0-9]+)?)", source=RAW_PRODUCTS
    ),
)
def clean_meta_legacy(spark, sf_dir):
    return _with_text_arrays(cleaning.clean_products(raw_products(spark, sf_dir), legacy=True))


def _with_text_arrays(products):
    """Arrays as text, which every comparison tool can sort and hash."""
    joined = {c: F.array_join(c, ",") for c in ("also_buy", "also_view")}
    return products.withColumns(joined)


CLEAN_COUNTS = f"""
    WITH typed AS (SELECT *, "reviewerID" IS NOT NULL AND asin IS NOT NULL
                             AND rating IS NOT NULL AS valid FROM ({TYPED_REVIEWS})),
         kept AS (SELECT DISTINCT "reviewerID", asin, unix_time FROM typed WHERE valid),
         parts AS (SELECT *, p_asin IS NOT NULL AS valid
                   FROM (SELECT asin AS p_asin FROM ({RAW_PRODUCTS})))
    SELECT 'reviews' AS table_name, raw_rows, 0::BIGINT AS corrupt_rows, rejected_rows,
           raw_rows - rejected_rows - clean_rows AS surplus_rows, clean_rows
    FROM (SELECT (SELECT COUNT(*) FROM typed) AS raw_rows,
                 (SELECT COUNT(*) FROM typed WHERE NOT valid) AS rejected_rows,
                 (SELECT COUNT(*) FROM kept) AS clean_rows)
    UNION ALL
    SELECT 'products', raw_rows, 0::BIGINT, rejected_rows, raw_rows - rejected_rows - clean_rows, clean_rows
    FROM (SELECT (SELECT COUNT(*) FROM parts) AS raw_rows,
                 (SELECT COUNT(*) FROM parts WHERE NOT valid) AS rejected_rows,
                 (SELECT COUNT(DISTINCT p_asin) FROM parts) AS clean_rows)
    """


@query("clean_counts", CLEAN_COUNTS)
def clean_counts(spark, sf_dir):
    raw = raw_reviews(spark, sf_dir)
    reviews = cleaning.review_counts(raw)
    products = cleaning.product_counts(raw_products(spark, sf_dir))
    return reviews.select(F.lit("reviews").alias("table_name"), "*").unionByName(
        products.select(F.lit("products").alias("table_name"), "*")
    )


DEDUP_LINES = """
    SELECT * EXCLUDE (rn)
    FROM (SELECT *, row_number() OVER (
                    PARTITION BY l_orderkey, l_linenumber
                    ORDER BY md5(concat_ws('|', l_returnflag, l_linestatus)), l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount,
                             l_tax, l_returnflag, l_linestatus, l_shipdate) AS rn
      FROM lineitem)
    WHERE rn = 1
    """


_COUNTS = (
    "raw_rows bigint, corrupt_rows bigint, rejected_rows bigint, surplus_rows bigint, clean_rows bigint"
)


@query("clean_counts_written", CLEAN_COUNTS)
def clean_counts_written(spark, sf_dir):
    """The same counts out of the jobs that write the clean tables."""
    folder = f"{shared_dir(spark)}/clean-{uuid.uuid4().hex}"
    raw = {"reviews": raw_reviews(spark, sf_dir), "products": raw_products(spark, sf_dir)}
    for name, df in raw.items():
        write_table(df, f"{folder}/raw-{name}")
    reviews = cleaning.write_clean_reviews(spark, f"{folder}/raw-reviews", f"{folder}/reviews")
    products = cleaning.write_clean_products(spark, f"{folder}/raw-products", f"{folder}/products")
    # Few numbers from two sessions, brought into this one.
    named = [("reviews", *reviews.first()), ("products", *products.first())]
    return spark.createDataFrame(named, f"table_name string, {_COUNTS}")


@query("dedup_by_key", DEDUP_LINES)
def dedup_lines(spark, sf_dir):
    return dedup_by_key(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])
