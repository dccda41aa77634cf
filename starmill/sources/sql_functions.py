"""SQL functions of the session, so that reports can be written as SQL text.

Spark inlines them into the query: no Python runs behind them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from starmill.functions.buckets import LENGTH_EDGES, LENGTH_LABELS, PRICE_EDGES, PRICE_LABELS
from starmill.functions.parsing import BY_PREFIX_PATTERN, PRICE_PATTERN
from starmill.functions.text import ASCII_WORD


def _case(value: str, edges: Sequence[float], results: Sequence) -> str:
    """A CASE over edges, the last result being open; null stays null."""
    steps = " ".join(f"WHEN {value} < {edge} THEN {result}" for edge, result in zip(edges, results))
    return f"CASE {steps} WHEN {value} IS NOT NULL THEN {results[len(edges)]} END"


def bucket_functions(name: str, edges: Sequence[float], labels: Sequence[str]) -> list[str]:
    """Statements for ``<name>_bucket``, the number, and ``<name>_label`` of a value."""
    numbers = range(1, len(labels) + 1)
    quoted = ["'" + label.replace("'", "''") + "'" for label in labels]
    create = "CREATE OR REPLACE TEMPORARY FUNCTION"
    return [
        f"{create} {name}_bucket(value DOUBLE) RETURNS INT RETURN {_case('value', edges, numbers)}",
        f"{create} {name}_label(value DOUBLE) RETURNS STRING RETURN {_case('value', edges, quoted)}",
    ]


def register_functions(spark: SparkSession) -> None:
    """parse_votes, parse_price, clean_brand, length_* and price_* buckets, and the table
    function words(text, min_chars)."""
    create = "CREATE OR REPLACE TEMPORARY FUNCTION"
    statements = [
        rf"""{create} parse_votes(raw STRING) RETURNS INT RETURN
             try_cast(regexp_replace(coalesce(raw, '0'), r',|\.[0-9]*\s*$', '') AS INT)""",
        f"""{create} parse_price(raw STRING) RETURNS DOUBLE RETURN
             try_cast(replace(regexp_extract(raw, r'{PRICE_PATTERN}', 1), ',', '') AS DOUBLE)""",
        rf"""{create} clean_brand(raw STRING) RETURNS STRING RETURN
             regexp_replace(regexp_replace(coalesce(raw, ''), r'{BY_PREFIX_PATTERN}', ''), r'\s+', ' ')""",
        # No WHERE around the words: Spark would then join the found ones back by the whole text.
        f"""{create} words(body STRING, min_chars INT) RETURNS TABLE (word STRING) RETURN
             SELECT lower(found) FROM explode(regexp_extract_all(body,
                 concat('[{ASCII_WORD}]{{', if(min_chars < 1, 1, min_chars), ',}}'), 0)) AS t(found)""",
        *bucket_functions("length", LENGTH_EDGES, LENGTH_LABELS),
        *bucket_functions("price", PRICE_EDGES, PRICE_LABELS),
    ]
    for statement in statements:
        spark.sql(statement)
