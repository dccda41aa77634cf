"""Reading numbers, labels and dates out of untrusted text columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns of the published tables. The LEGACY ones reproduce its
# quirks: a price stops at a thousands comma and "by " vanishes inside a brand too.
PRICE_PATTERN = r"\$([0-9][0-9,]*(?:\.[0-9]+)?)"
LEGACY_PRICE_PATTERN = r"\$([0-9]+(?:\.[0-9]+)?)"
BY_PREFIX_PATTERN = r"^\s*by\s+"
LEGACY_BY_PATTERN = r"by\s+"

SECONDS_PER_DAY = 86_400


def parse_count(text: Column) -> Column:
    """``"1,234"`` to 1234; null counts as 0; text that is no number gives null."""
    digits = F.regexp_replace(F.coalesce(text.cast("string"), F.lit("0")), r",|\.[0-9]*\s*$", "")
    return digits.try_cast("int")


def parse_price(text: Column, legacy: bool = False) -> Column:
    """The first dollar amount in a text as a double, null when there is none."""
    amount = F.regexp_extract(text, LEGACY_PRICE_PATTERN if legacy else PRICE_PATTERN, 1)
    return F.replace(amount, F.lit(","), F.lit("")).try_cast("double")


def clean_label(text: Column, legacy: bool = False) -> Column:
    """Drop a leading "by", squeeze white space; null becomes an empty string."""
    pattern = LEGACY_BY_PATTERN if legacy else BY_PREFIX_PATTERN
    stripped = F.regexp_replace(F.coalesce(text, F.lit("")), pattern, "")
    return F.regexp_replace(stripped, r"\s+", " ")


def blank_to_default(text: Column, default: str) -> Column:
    """Null, empty and all-blank values become ``default``; others are trimmed."""
    return F.coalesce(F.nullif(F.trim(text), F.lit("")), F.lit(default))


def utc_date(epoch_seconds: Column) -> Column:
    """The UTC calendar date of an epoch second, whatever the session time zone is."""
    days = F.floor(epoch_seconds / F.lit(SECONDS_PER_DAY)).try_cast("int")
    return F.date_from_unix_date(days)
