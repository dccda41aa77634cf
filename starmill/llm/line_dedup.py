"""Removing lines, sentences of lines or paragraphs that occurred before."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmill.llm.common import batches, stored

#: A unit has a word at least; what has none holds nothing that could repeat.
MIN_WORDS = 1
#: Sentences of fewer characters stay with their neighbours: alone they repeat by chance.
MIN_CHARS = 20
_SPLIT = {"line": re.compile(r"\n"), "paragraph": re.compile(r"\n[ \t\r\f\v]*\n\s*")}
#: The shortest run of at least ``MIN_CHARS`` that ends like a sentence, or what is left.
_SENTENCES = r".{%d,}?(?:[.!?]+[ \t]+|[。！？]+)|.+"
#: Marks belong to the letters they stand on, in scripts without spaces too.
_WORD = regex.compile(r"[\p{L}\p{M}\p{N}_]+")
UNITS = "doc_id long, unit int, start int, end int, digest binary"
_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("unit", pa.int32()),
        ("start", pa.int32()),
        ("end", pa.int32()),
        ("digest", pa.binary()),
    ]
)


def units_of(text: str, by: str, min_chars: int = MIN_CHARS) -> Iterator[tuple[int, int]]:
    """Start and end of every unit, in characters; separators belong to none."""
    at = 0
    for gap in _SPLIT["line" if by == "sentence" else by].finditer(text):
        yield from _parts(text, at, gap.start(), by, min_chars)
        at = gap.end()
    yield from _parts(text, at, len(text), by, min_chars)


def _parts(text: str, start: int, end: int, by: str, min_chars: int) -> Iterator[tuple[int, int]]:
    """A line or paragraph as it is, or the sentences that a line consists of without gaps.

    Where sentences end depends on the line from the last long sentence on only, so a
    passage falls into the same units wherever it stands in a line, but for its ends.
    """
    if by != "sentence" or end - start < 2 * min_chars:
        yield start, end
        return
    ends = [m.end() for m in regex.finditer(_SENTENCES % min_chars, text, regex.DOTALL, start, end)]
    if len(ends) > 1 and end - ends[-2] < min_chars:
        del ends[-2]
    yield from zip([start, *ends[:-1]], ends, strict=True)


def normalised(unit: str) -> list[str]:
    """Words in lower case, without punctuation and whatever the white space."""
    return _WORD.findall(unit.lower())


def text_units(
    docs: DataFrame, by: str = "line", min_words: int = MIN_WORDS, min_chars: int = MIN_CHARS
) -> DataFrame:
    """Every unit of at least ``min_words`` words with offsets and digest of its words."""

    def split(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for batch in rows:
                ids = batch.column("doc_id").to_pylist()
                for doc_id, scalar in zip(ids, batch.column("text"), strict=True):
                    text = scalar.as_py()
                    for i, (start, end) in enumerate(units_of(text, by, min_chars)):
                        words = normalised(text[start:end])
                        if len(words) >= min_words:
                            digest = hashlib.md5(" ".join(words).encode(), usedforsecurity=False)
                            yield doc_id, i, start, end, digest.digest()

        return batches(found(), _ARROW)

    rows = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    return rows.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        split, UNITS
    )


def repeated_units(
    docs: DataFrame, by: str = "line", min_words: int = MIN_WORDS, min_chars: int = MIN_CHARS
) -> DataFrame:
    """The units to remove: doc_id, unit, start, end, first_doc_id, first_unit.

    Units are lines, paragraphs or the sentences of lines (``by``), equal when their
    words agree. Sentences of fewer than ``min_chars`` characters go with the following
    one, or with the one before at the end of a line, so that a line that repeats is
    removed whole however short its sentences. Of equal units the one with the smallest
    (doc_id, unit) stays and all others are returned, with their offsets in the original
    text (in characters) and the place that stays. Units of fewer than ``min_words``
    words, by default those without any, are never removed. Digests are counted ahead of
    the shuffle, so that a line in a third of all documents is one row per task; only
    digests that repeat are joined back, as two plain shuffles that Spark can split.

    Null texts and ids give no units; rows that repeat a doc_id and a text are one
    document, whose units stay or go alike in all its rows; empty tables give no rows;
    other columns are ignored.
    """
    units = stored(text_units(docs, by, min_words, min_chars), "text-units")
    place = F.struct("doc_id", "unit", "start")
    first = units.groupBy("digest").agg(F.min(place).alias("first"), F.count("*").alias("copies"))
    repeats = stored(first.where(F.col("copies") > 1).select("digest", "first"), "repeated-units")
    removed = units.join(repeats, "digest").where(place != F.col("first"))
    return removed.select(
        "doc_id",
        "unit",
        "start",
        "end",
        F.col("first.doc_id").alias("first_doc_id"),
        F.col("first.unit").alias("first_unit"),
    )
