"""Text operators over whole documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from starmill.catalog.bindings import DOCUMENT_REVIEWS, document_reviews, table
from starmill.catalog.filters import STOP_WORDS_SQL
from starmill.catalog.registry import query
from starmill.functions.text import join_texts, normalize_text, split_words
from starmill.operators.keywords import clean_tokens, rank_keywords

NORMALIZED = """
    lower(regexp_replace(summary || ' ' || COALESCE("reviewText", ''),
                         '[^a-zA-Z0-9 ]', ' ', 'g'))
"""


@query(
    "normalize_text",
    f'SELECT "reviewerID" AS doc_id, {NORMALIZED} AS normalized FROM ({DOCUMENT_REVIEWS})',
)
def normalized_documents(spark, sf_dir):
    text = join_texts(F.col("summary"), F.col("reviewText"))
    return document_reviews(spark, sf_dir).select(
        F.col("reviewerID").alias("doc_id"), normalize_text(text).alias("normalized")
    )


@query(
    "tokenize",
    f"""
    SELECT token, COUNT(*) AS occurrences
    FROM (SELECT unnest(regexp_split_to_array({NORMALIZED}, ' +')) AS token
          FROM ({DOCUMENT_REVIEWS}))
    GROUP BY token
    """,
)
def tokenized_documents(spark, sf_dir):
    text = join_texts(F.col("summary"), F.col("reviewText"))
    return (
        document_reviews(spark, sf_dir)
        .select(F.explode(split_words(normalize_text(text))).alias("token"))
        .groupBy("token")
        .agg(F.count("*").alias("occurrences"))
    )


def cleaned(source: str, group: str) -> str:
    """SQL for the keyword occurrences of a source with the given group column."""
    return f"""
        SELECT {group}, token
        FROM (SELECT {group}, unnest(regexp_extract_all({NORMALIZED}, '[^ ]+')) AS token
              FROM ({source}))
        WHERE length(token) >= 3 AND NOT regexp_matches(token, '^[0-9]+$')
          AND token NOT IN ({STOP_WORDS_SQL})
    """


def ranked(tokens: str, group: str, k: int = 40) -> str:
    """SQL for the keyword ranking of a statement giving keyword occurrences."""
    return f"""
        SELECT {group}, CAST(keyword_rank AS INTEGER) AS keyword_rank, keyword, keyword_count,
               ROUND(keyword_count * 10000.0 / total, 2) AS frequency_per_10k_words
        FROM (SELECT {group}, token AS keyword, COUNT(*) AS keyword_count,
                     SUM(COUNT(*)) OVER (PARTITION BY {group}) AS total,
                     row_number() OVER (PARTITION BY {group}
                                        ORDER BY COUNT(*) DESC, token) AS keyword_rank
              FROM ({tokens}) GROUP BY {group}, token)
        WHERE keyword_rank <= {k}
    """


LANGUAGE_TEXTS = """
    SELECT lang, source AS summary, text AS "reviewText" FROM documents
"""


def _language_tokens(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return clean_tokens(documents, join_texts(F.col("source"), F.col("text")), ["lang"])


@query(
    "clean_tokens",
    f"""
    SELECT lang, token, COUNT(*) AS occurrences
    FROM ({cleaned(LANGUAGE_TEXTS, "lang")}) GROUP BY lang, token
    """,
)
def cleaned_documents(spark, sf_dir):
    tokens = _language_tokens(spark, sf_dir)
    return tokens.groupBy("lang", "token").agg(F.count("*").alias("occurrences"))


@query("keyword_share", ranked(cleaned(LANGUAGE_TEXTS, "lang"), "lang", 100))
def keyword_share(spark, sf_dir):
    """The same ranking for any group: here the hundred keywords of each language."""
    return rank_keywords(_language_tokens(spark, sf_dir), "lang", k=100)
