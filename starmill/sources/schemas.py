"""Schemas of the raw files.

Scalars are read as text and parsed by the cleaning job, because raw files mix quoted
and bare numbers; a line that is no JSON at all ends up in ``_corrupt_record``.
"""

from __future__ import annotations

CORRUPT = "_corrupt_record"

RAW_REVIEWS = f"""
    reviewerID string, asin string, overall string, verified string, reviewText string,
    summary string, unixReviewTime string, reviewTime string, vote string, {CORRUPT} string
"""

RAW_PRODUCTS = f"""
    asin string, title string, brand string, price string,
    also_buy array<string>, also_view array<string>, {CORRUPT} string
"""
