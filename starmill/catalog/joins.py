"""Joins of whole fact tables with product tables and with their own totals."""

from __future__ import annotations

from pyspark.sql import functions as F

from starmill.catalog.bindings import (
    LINE_REVIEWS,
    ORDER_REVIEWS,
    PART_PRODUCTS,
    line_reviews,
    order_reviews,
    part_products,
    table,
)
from starmill.catalog.cleaning import DEDUP_LINES
from starmill.catalog.registry import query
from starmill.operators.joins import lookup_join, with_group_size
from starmill.sources.bucketed import (
    dedup_landed,
    join_landed,
    land_facts,
    land_lookup,
    plan_buckets,
)


@query(
    "join_inner_dim",
    f"""
    SELECT asin, r.rating, p.price, p.brand
    FROM ({LINE_REVIEWS}) r JOIN ({PART_PRODUCTS}) p USING (asin)
    WHERE p.price IS NOT NULL AND p.price >= 0
    """,
)
def join_inner_dim(spark, sf_dir):
    reviews = line_reviews(spark, sf_dir).select("asin", "rating")
    products = part_products(spark, sf_dir).where(F.col("price") >= 0)
    return lookup_join(reviews, products, "asin").select("asin", "rating", "price", "brand")


@query(
    "join_left_fill",
    """
    SELECT doc_id, lang, COALESCE(quality, -1) AS quality, COALESCE(toxic, 0) AS toxic
    FROM documents LEFT JOIN labels USING (doc_id)
    """,
)
def join_left_fill(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return lookup_join(documents, table(spark, sf_dir, "labels"), "doc_id", "left").select(
        "doc_id",
        "lang",
        F.coalesce("quality", F.lit(-1)).alias("quality"),
        F.coalesce("toxic", F.lit(0)).alias("toxic"),
    )


@query(
    "join_own_total",
    f"""
    SELECT r.*, u.n AS user_review_count,
           CASE WHEN u.n >= 10 THEN 'high_frequency_user' ELSE 'ordinary_user' END AS user_group
    FROM ({ORDER_REVIEWS}) r
    JOIN (SELECT "reviewerID", COUNT(*) AS n FROM ({ORDER_REVIEWS}) GROUP BY "reviewerID") u
        ON r."reviewerID" = u."reviewerID"
    """,
)
def join_own_total(spark, sf_dir):
    sized = with_group_size(order_reviews(spark, sf_dir), "reviewerID", "user_review_count")
    frequent = F.col("user_review_count") >= 10
    group = F.when(frequent, "high_frequency_user").otherwise("ordinary_user")
    return sized.select("*", group.alias("user_group"))


# Orders with a key that a third of them share, and an order priority as its only lookup.
SKEWED = """
    SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN -1 WHEN o_orderkey % 7 = 0 THEN NULL
                            ELSE o_custkey END AS k
    FROM orders
"""
NAMES = """
    SELECT c_custkey AS k, c_name AS name FROM customer WHERE c_custkey % 2 = 0
    UNION ALL SELECT -1, 'everybody'
"""


def _skewed(spark, sf_dir):
    order = F.col("o_orderkey")
    key = F.when(order % 3 == 0, F.lit(-1)).when(order % 7 == 0, None).otherwise(F.col("o_custkey"))
    return table(spark, sf_dir, "orders").select("o_orderkey", key.alias("k"))


def _names(spark, sf_dir):
    even = table(spark, sf_dir, "customer").where("c_custkey % 2 = 0")
    everybody = spark.range(1).select(F.lit(-1).cast("bigint"), F.lit("everybody"))
    return even.select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name")).union(everybody)


@query("join_inner_split", f"SELECT o_orderkey, k, name FROM ({SKEWED}) JOIN ({NAMES}) USING (k)")
def join_inner_split(spark, sf_dir):
    joined = lookup_join(_skewed(spark, sf_dir), _names(spark, sf_dir), "k", parts=50, min_rows=1)
    return joined.select("o_orderkey", "k", "name")


@query("join_left_split", f"SELECT o_orderkey, k, name FROM ({SKEWED}) LEFT JOIN ({NAMES}) USING (k)")
def join_left_split(spark, sf_dir):
    facts, names = _skewed(spark, sf_dir), _names(spark, sf_dir)
    joined = lookup_join(facts, names, "k", "left", parts=50, min_rows=1)
    return joined.select("o_orderkey", "k", "name")


@query(
    "join_own_total_skewed",
    f"""
    SELECT o_orderkey, k, COUNT(*) OVER (PARTITION BY k) AS n FROM ({SKEWED}) WHERE k IS NOT NULL
    """,
)
def join_own_total_skewed(spark, sf_dir):
    sized = with_group_size(_skewed(spark, sf_dir), "k", "n", parts=50, min_rows=1)
    return sized.select("o_orderkey", "k", "n")


# Order lines and orders laid side by side by order, the lines by ship year too.
def _landed(spark, sf_dir, **limits):
    lines = table(spark, sf_dir, "lineitem").withColumn("ship_year", F.year("l_shipdate"))
    layout = plan_buckets(lines, "l_orderkey", ["l_orderkey", "l_linenumber"], **limits)
    return land_facts(lines, layout, ("ship_year",)), layout


@query("dedup_bucketed", DEDUP_LINES)
def dedup_bucketed(spark, sf_dir):
    lines, layout = _landed(spark, sf_dir)
    return dedup_landed(lines, layout).drop("ship_year")


@query("dedup_bucketed_hot", DEDUP_LINES)
def dedup_bucketed_hot(spark, sf_dir):
    """The same with limits so low that many orders are dealt over parts."""
    lines, layout = _landed(spark, sf_dir, parts=50_000, min_rows=3)
    return dedup_landed(lines, layout).drop("ship_year")


LINES_OF_ORDERS = """
    SELECT l_orderkey, l_linenumber, l_quantity, o_orderpriority
    FROM lineitem {how} JOIN (SELECT o_orderkey AS l_orderkey, o_orderpriority FROM orders
                              WHERE o_totalprice >= 150000) USING (l_orderkey)
"""


def _lines_of_orders(spark, sf_dir, how, **limits):
    lines, layout = _landed(spark, sf_dir, **limits)
    dear = table(spark, sf_dir, "orders").where("o_totalprice >= 150000")
    orders = land_lookup(dear.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority"), layout)
    joined = join_landed(lines, orders, layout, how)
    return joined.select("l_orderkey", "l_linenumber", "l_quantity", "o_orderpriority")


@query("join_bucketed", LINES_OF_ORDERS.format(how="INNER"))
def join_bucketed(spark, sf_dir):
    return _lines_of_orders(spark, sf_dir, "inner")


@query("join_left_bucketed", LINES_OF_ORDERS.format(how="LEFT"))
def join_left_bucketed(spark, sf_dir):
    return _lines_of_orders(spark, sf_dir, "left", parts=100_000, min_rows=8)
