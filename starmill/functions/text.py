"""Text normalisation, tokens and labels."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

ASCII_WORD = "a-zA-Z0-9"

# The stop words of the published keyword table.
STOP_WORDS = (
    "the", "and", "for", "with", "this", "that", "these", "those", "you",
    "your", "are", "was", "were", "have", "has", "had", "but", "not", "all",
    "can", "don", "didn", "doesn", "do", "does", "did", "get", "got", "out",
    "one", "two", "just", "from", "they", "them", "his", "her", "she", "him",
    "its", "our", "their", "there", "then", "than", "too", "very", "more",
    "most", "some", "any", "other", "same", "into", "about", "would",
    "could", "should", "when", "what", "which", "who", "why", "how", "been",
    "will", "also", "only", "really", "much", "many", "because", "after",
    "before", "over", "under", "again", "first", "now", "way", "back", "off",
    "thing", "lot", "little", "game", "games", "play", "played", "playing",
    "product", "amazon", "video", "review", "buy", "bought", "use", "used",
    "using", "like", "make", "made", "time", "even", "still", "well", "good",
)


def text_length(text: Column) -> Column:
    """Characters in a text, 0 for null."""
    return F.length(F.coalesce(text, F.lit("")))


def join_texts(headline: Column, body: Column) -> Column:
    """Headline and whole body as one text."""
    return F.concat_ws(" ", F.coalesce(headline, F.lit("")), F.coalesce(body, F.lit("")))


def normalize_text(text: Column, word_chars: str = ASCII_WORD) -> Column:
    """Lower-cased text in which every character outside ``word_chars`` is a space."""
    return F.lower(F.regexp_replace(text, f"[^{word_chars} ]", " "))


def split_words(normalized: Column) -> Column:
    """Words of a normalised text; leading or trailing blanks give an empty word."""
    return F.split(normalized, " +")


def word_array(text: Column, word_chars: str = ASCII_WORD, min_chars: int = 1) -> Column:
    """All words of a text of at least ``min_chars`` characters, in their own case.

    One pass that collects the words themselves: ``split_words(normalize_text(text))``
    gives the same words in lower case, but rewrites the whole text twice to get them.
    """
    return F.regexp_extract_all(text, F.lit(f"[{word_chars}]{{{min_chars},}}"), F.lit(0))


def is_keyword(word: Column, stop_words: Iterable[str] = STOP_WORDS) -> Column:
    """Not a number, and not one of a fixed list of stop words.

    Digits sort ahead of "a", which spares most words the regular expression.
    """
    number = (word < "a") & word.rlike("^[0-9]+$")
    return ~word.isin(list(stop_words)) & ~number


def title_label(code: Column) -> Column:
    """``some_code`` to ``Some Code``."""
    return F.initcap(F.replace(code, F.lit("_"), F.lit(" ")))


def short_label(text: Column, chars: int = 45) -> Column:
    """The first characters of a name, for an axis label."""
    return F.substring(text, 1, chars)
