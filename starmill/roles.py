"""Column roles: which column of a fact or product table plays which part."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Roles:
    """Names of the columns an analysis reads; defaults are the clean review columns."""

    user: str = "reviewerID"
    item: str = "asin"
    time: str = "unix_time"
    score: str = "rating"
    flag: str = "verified"
    votes: str = "helpful_votes"
    length: str = "review_length"
    year: str = "review_year"
    headline: str = "summary"
    body: str = "reviewText"
    brand: str = "brand"
    price: str = "price"


REVIEW_ROLES = Roles()
