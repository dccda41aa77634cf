"""SQL strings over bound views, and round trips through files in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from starmill.catalog.bindings import (
    DOCUMENT_REVIEWS,
    LINE_REVIEWS,
    document_reviews,
    line_reviews,
    raw_reviews,
    table,
)
from starmill.catalog.cleaning import CLEAN_REVIEWS
from starmill.catalog.registry import query
from starmill.plans import analyses, cleaning
from starmill.session import shared_dir
from starmill.sources.readers import (
    land_json_lines,
    quarantine_lines,
    read_result_csv,
    read_table,
    register_views,
)
from starmill.sources.schemas import RAW_REVIEWS as RAW_SCHEMA
from starmill.sources.writers import write_report, write_table

CTE_WINDOW = """
    WITH scored AS (SELECT rating, COUNT(*) AS n FROM {reviews} WHERE rating IS NOT NULL GROUP BY rating)
    SELECT rating, n, RANK() OVER (ORDER BY n DESC, rating) AS place,
           n - LAG(n, 1, 0) OVER (ORDER BY rating) AS step
    FROM scored
"""


@query("sql_cte_window", CTE_WINDOW.format(reviews=f"({LINE_REVIEWS})"))
def sql_cte_window(spark, sf_dir):
    register_views({"bound_lines": line_reviews(spark, sf_dir)})
    found = spark.sql(CTE_WINDOW.format(reviews="bound_lines"))
    return found.withColumn("place", found["place"].cast("bigint"))


@query(
    "sql_explode_tokens",
    f"""
    SELECT word, COUNT(*) AS n
    FROM (SELECT unnest(string_split(lower("reviewText"), ' ')) AS word FROM ({DOCUMENT_REVIEWS}))
    WHERE length(word) >= 4 GROUP BY word HAVING COUNT(*) >= 5
    """,
)
def sql_explode_tokens(spark, sf_dir):
    register_views({"bound_texts": document_reviews(spark, sf_dir)})
    return spark.sql(
        """
        SELECT word, COUNT(*) AS n FROM bound_texts
        LATERAL VIEW EXPLODE(SPLIT(LOWER(reviewText), ' ')) words AS word
        WHERE LENGTH(word) >= 4 GROUP BY word HAVING COUNT(*) >= 5
        """
    )


HAVING_TOP = """
    SELECT reviewer, COUNT(*) AS n, ROUND(AVG(rating), 3) AS avg_rating
    FROM (SELECT {reviewer} AS reviewer, rating FROM {reviews}) rated
    GROUP BY reviewer HAVING COUNT(*) >= 20
    ORDER BY n DESC, reviewer LIMIT 25
"""


@query("sql_having_top", HAVING_TOP.format(reviewer='"reviewerID"', reviews=f"({LINE_REVIEWS})"))
def sql_having_top(spark, sf_dir):
    register_views({"bound_lines": line_reviews(spark, sf_dir)})
    return spark.sql(HAVING_TOP.format(reviewer="reviewerID", reviews="bound_lines"))


def _fresh(spark, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query("roundtrip_json", CLEAN_REVIEWS)
def roundtrip_json(spark, sf_dir):
    """Raw reviews as gzip JSON lines, landed and cleaned."""
    lines, landed = _fresh(spark, "raw-lines"), _fresh(spark, "landed")
    raw_reviews(spark, sf_dir).write.option("compression", "gzip").json(lines)
    return cleaning.clean_reviews(land_json_lines(spark, lines, RAW_SCHEMA, landed))


@query(
    "roundtrip_csv",
    f"""
    SELECT rating, COUNT(*) AS review_count,
           ROUND(COUNT(*) * 100.0 / SUM(COUNT(*)) OVER (), 2) AS review_pct
    FROM ({LINE_REVIEWS}) WHERE rating IS NOT NULL GROUP BY rating
    """,
)
def roundtrip_csv(spark, sf_dir):
    path = _fresh(spark, "report")
    write_report(analyses.rating_distribution(line_reviews(spark, sf_dir)), path, one_file=True)
    return read_result_csv(spark, path, "rating double, review_count bigint, review_pct double")


@query("roundtrip_parquet", "SELECT * FROM orders")
def roundtrip_parquet(spark, sf_dir):
    path = _fresh(spark, "orders")
    write_table(table(spark, sf_dir, "orders"), path, ("o_orderstatus",))
    return read_table(spark, path)


@query(
    "corrupt_lines",
    """
    SELECT line, COUNT(*) AS copies, true AS has_file FROM (
        SELECT CASE WHEN source = 'src5' THEN '{"reviewerID": "' || CAST(doc_id AS VARCHAR)
                    ELSE 'no json ' || CAST(n_chars AS VARCHAR) END AS line
        FROM documents WHERE source IN ('src5', 'src7')
    ) GROUP BY line
    """,
)
def corrupt_lines(spark, sf_dir):
    """Raw lines of two sources cut off or no JSON at all, found with their files."""
    lines, landed, bad = (_fresh(spark, name) for name in ("raw-lines", "landed", "bad-lines"))
    documents = table(spark, sf_dir, "documents")
    whole = F.to_json(F.struct(F.col("doc_id").cast("string").alias("reviewerID"), F.col("text").alias("reviewText")))
    cut = F.concat(F.lit('{"reviewerID": "'), F.col("doc_id").cast("string"))
    broken = F.when(F.col("source") == "src5", cut).when(
        F.col("source") == "src7", F.concat(F.lit("no json "), F.col("n_chars").cast("string"))
    )
    documents.select(F.coalesce(broken, whole).alias("value")).write.option("compression", "gzip").text(lines)
    _, found = quarantine_lines(spark, lines, RAW_SCHEMA, landed, bad)
    has_file = F.every(F.col("raw_file").endswith(".gz") & F.col("block_start").isNotNull())
    return found.groupBy("line").agg(F.count("*").alias("copies"), has_file.alias("has_file"))
