"""Projections, casts, null handling, labels and scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from starmill.catalog.bindings import (
    LINE_REVIEWS,
    RAW_PRODUCTS,
    RAW_REVIEWS,
    line_reviews,
    raw_products,
    raw_reviews,
    table,
)
from starmill.catalog.registry import query
from starmill.functions.buckets import (
    LENGTH_EDGES,
    LENGTH_LABELS,
    bucket_label,
    bucket_order,
)
from starmill.functions.parsing import (
    blank_to_default,
    clean_label,
    parse_count,
    parse_price,
    utc_date,
)
from starmill.functions.text import short_label, text_length, title_label
from starmill.operators.profile import profile_table, sample_rows
from starmill.sources.readers import read_table, register_views


def bucket_sql(value: str, names) -> str:
    """A CASE over edges, the last name being open."""
    edges, results = names
    cases = " ".join(f"WHEN {value} < {e} THEN {r}" for e, r in zip(edges, results))
    return f"CASE {cases} ELSE {results[len(edges)]} END"


def quoted(labels) -> list[str]:
    return [f"'{label}'" for label in labels]


@query(
    "scan_parquet",
    """
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
    """,
)
def scan_parquet(spark, sf_dir):
    return read_table(spark, f"{sf_dir}/customer.parquet")


@query(
    "sql_view",
    """
    SELECT n_regionkey AS region, COUNT(*) AS customers, MAX(c_acctbal) AS best_balance
    FROM customer JOIN nation ON c_nationkey = n_nationkey
    GROUP BY n_regionkey
    """,
)
def sql_view(spark, sf_dir):
    register_views(
        {f"starmill_{name}": table(spark, sf_dir, name) for name in ("customer", "nation")}
    )
    return spark.sql(
        """
        SELECT n.n_regionkey AS region, count(*) AS customers,
               max(c.c_acctbal) AS best_balance
        FROM starmill_customer c JOIN starmill_nation n ON c.c_nationkey = n.n_nationkey
        GROUP BY n.n_regionkey
        """
    )


@query(
    "profile_table",
    """
    SELECT 'documents' AS table_name, CAST(column_position AS INTEGER) AS column_position,
           column_name, data_type, row_count
    FROM (VALUES (1, 'doc_id', 'bigint'), (2, 'text', 'string'), (3, 'lang', 'string'),
                 (4, 'source', 'string'), (5, 'n_chars', 'bigint'))
             AS s(column_position, column_name, data_type),
         (SELECT COUNT(*) AS row_count FROM documents)
    """,
)
def profile_documents(spark, sf_dir):
    return profile_table(table(spark, sf_dir, "documents"), "documents")


@query(
    "profile_sample",
    """
    SELECT o_orderkey, o_custkey, o_orderpriority FROM orders
    ORDER BY md5(concat_ws('|', o_orderkey, o_custkey, o_orderpriority)) LIMIT 25
    """,
)
def profile_sample(spark, sf_dir):
    columns = ["o_orderkey", "o_custkey", "o_orderpriority"]
    return sample_rows(table(spark, sf_dir, "orders"), columns, 25)


@query(
    "project_cast",
    """
    SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_quantity AS INTEGER) AS quantity,
           CAST(l_linenumber AS DOUBLE) AS line, CAST(l_shipdate AS DATE) AS ship_date,
           l_returnflag = 'R' AS returned, TRY_CAST(l_returnflag AS BIGINT) AS no_number
    FROM lineitem
    """,
)
def project_cast(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_linenumber").cast("double").alias("line"),
        F.col("l_shipdate").cast("date").alias("ship_date"),
        (F.col("l_returnflag") == "R").alias("returned"),
        F.col("l_returnflag").try_cast("bigint").alias("no_number"),
    )


@query(
    "bucketize",
    f"""
    SELECT rating, helpful_votes,
           CAST(CASE WHEN helpful_votes < 2 THEN 1 WHEN helpful_votes < 4 THEN 2
                     WHEN helpful_votes >= 4 THEN 3 END AS INTEGER) AS votes_order,
           {bucket_sql("review_length", (LENGTH_EDGES, quoted(LENGTH_LABELS)))} AS length_bucket
    FROM ({LINE_REVIEWS})
    """,
)
def bucketize(spark, sf_dir):
    return line_reviews(spark, sf_dir).select(
        "rating",
        "helpful_votes",
        bucket_order(F.col("helpful_votes"), (2, 4)).alias("votes_order"),
        bucket_label(
            bucket_order(F.col("review_length"), LENGTH_EDGES), LENGTH_LABELS, LENGTH_EDGES
        ).alias("length_bucket"),
    )


@query(
    "fill_null",
    f"""
    SELECT asin, COALESCE(helpful_votes, 0) AS votes, COALESCE(review_year, -1) AS year
    FROM ({LINE_REVIEWS})
    """,
)
def fill_null(spark, sf_dir):
    return line_reviews(spark, sf_dir).select(
        "asin",
        F.coalesce("helpful_votes", F.lit(0)).alias("votes"),
        F.coalesce("review_year", F.lit(-1)).alias("year"),
    )


@query(
    "blank_to_default",
    """
    SELECT p_partkey, COALESCE(NULLIF(trim(brand), ''), 'Unknown') AS brand
    FROM (SELECT p_partkey, CASE WHEN p_size < 5 THEN '  ' WHEN p_size < 45
                                 THEN ' ' || p_brand || ' ' END AS brand FROM part)
    """,
)
def blank_brand(spark, sf_dir):
    size = F.col("p_size")
    padded = F.concat(F.lit(" "), "p_brand", F.lit(" "))
    brand = F.when(size < 5, F.lit("  ")).when(size < 45, padded)
    return table(spark, sf_dir, "part").select(
        "p_partkey", blank_to_default(brand, "Unknown").alias("brand")
    )


@query(
    "label_threshold",
    f"""
    SELECT asin, CASE WHEN verified THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS verified_numeric,
           CASE WHEN helpful_votes > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_helpful
    FROM ({LINE_REVIEWS})
    """,
)
def label_threshold(spark, sf_dir):
    return line_reviews(spark, sf_dir).select(
        "asin",
        F.when(F.col("verified"), 1.0).otherwise(0.0).alias("verified_numeric"),
        F.when(F.col("helpful_votes") > 0, 1.0).otherwise(0.0).alias("is_helpful"),
    )


@query(
    "parse_count",
    f"""
    SELECT vote, TRY_CAST(replace(COALESCE(vote, '0'), ',', '') AS INTEGER) AS votes
    FROM ({RAW_REVIEWS})
    """,
)
def votes_of_documents(spark, sf_dir):
    return raw_reviews(spark, sf_dir).select("vote", parse_count(F.col("vote")).alias("votes"))


PRICE_SQL = r"""
    SELECT title, price AS price_raw,
           TRY_CAST(replace(regexp_extract(price, '{pattern}', 1), ',', '') AS DOUBLE) AS price
    FROM ({source})
"""


@query(
    "parse_price",
    PRICE_SQL.format(pattern=r"\$([0-9][0-9,]*(?:\.[0-9]+)?)", source=RAW_PRODUCTS),
)
def prices_of_parts(spark, sf_dir):
    return _prices(spark, sf_dir, legacy=False)


@query(
    "parse_price_legacy",
    PRICE_SQL.format(pattern=r"\$([0-9]+(?:\.[0-9]+)?)", source=RAW_PRODUCTS),
)
def legacy_prices_of_parts(spark, sf_dir):
    return _prices(spark, sf_dir, legacy=True)


def _prices(spark, sf_dir, legacy):
    price = F.col("price")
    return raw_products(spark, sf_dir).select(
        "title", price.alias("price_raw"), parse_price(price, legacy).alias("price")
    )


LABEL_SQL = r"""
    SELECT title, regexp_replace(regexp_replace(COALESCE(brand, ''), '{pattern}', '', 'g'),
                                 '\s+', ' ', 'g') AS brand
    FROM ({source})
"""


@query("clean_label", LABEL_SQL.format(pattern=r"^\s*by\s+", source=RAW_PRODUCTS))
def brands_of_parts(spark, sf_dir):
    return raw_products(spark, sf_dir).select("title", clean_label(F.col("brand")).alias("brand"))


@query("clean_label_legacy", LABEL_SQL.format(pattern=r"by\s+", source=RAW_PRODUCTS))
def legacy_brands_of_parts(spark, sf_dir):
    return raw_products(spark, sf_dir).select(
        "title", clean_label(F.col("brand"), legacy=True).alias("brand")
    )


@query(
    "date_parts",
    """
    SELECT o_orderkey, day AS review_date, CAST(year(day) AS INTEGER) AS review_year,
           CAST(month(day) AS INTEGER) AS review_month
    FROM (SELECT o_orderkey, CAST(make_timestamp((o_orderkey * 7919 + 1355356799) * 1000000)
                                  AS DATE) AS day FROM orders)
    """,
)
def date_parts(spark, sf_dir):
    day = utc_date(F.col("o_orderkey") * 7919 + 1_355_356_799)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        day.alias("review_date"),
        F.year(day).alias("review_year"),
        F.month(day).alias("review_month"),
    )


@query(
    "text_length",
    """
    SELECT doc_id, CAST(length(COALESCE(text, '')) AS INTEGER) AS chars,
           CASE WHEN length(COALESCE(text, '')) > 0 THEN 1 ELSE 0 END AS has_text
    FROM documents
    """,
)
def lengths_of_documents(spark, sf_dir):
    length = text_length(F.col("text"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", length.alias("chars"), F.when(length > 0, 1).otherwise(0).alias("has_text")
    )


@query(
    "chart_label",
    """
    SELECT p_partkey, upper(type[1]) || lower(type[2:]) || ' ' || upper(name[1]) || name[2:]
                      AS label, (p_type || ' ' || p_name)[1:12] AS short
    FROM (SELECT *, p_type AS type, split_part(p_name, ' ', 1) AS name FROM part)
    """,
)
def labels_of_parts(spark, sf_dir):
    code = F.concat_ws("_", "p_type", F.split_part("p_name", F.lit(" "), F.lit(1)))
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        title_label(code).alias("label"),
        short_label(F.concat_ws(" ", "p_type", "p_name"), 12).alias("short"),
    )
