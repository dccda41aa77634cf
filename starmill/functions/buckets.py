"""Ordered buckets and the rounding used by the reports."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bucket edges and labels of the published tables. A bucket ends before
# its edge; the last one is open.
LENGTH_EDGES = (100, 300, 700, 1500)
LENGTH_LABELS = ("0-99 chars", "100-299 chars", "300-699 chars", "700-1499 chars", "1500+ chars")
PRICE_EDGES = (10, 25, 50, 75, 100)
PRICE_LABELS = ("$0-9.99", "$10-24.99", "$25-49.99", "$50-74.99", "$75-99.99", "$100+")


def bucket_order(value: Column, edges: Sequence[float]) -> Column:
    """1-based number of the bucket a value falls in; null stays null."""
    order = F.when(value.isNull(), None)
    for position, edge in enumerate(edges, start=1):
        order = order.when(value < edge, F.lit(position))
    return order.otherwise(F.lit(len(edges) + 1))


def bucket_label(order: Column, labels: Sequence[str], edges: Sequence[float]) -> Column:
    """Label of a bucket number. Group by the number and label the few results."""
    if len(labels) != len(edges) + 1:
        raise ValueError(f"{len(edges)} edges make {len(edges) + 1} buckets, not {len(labels)}")
    return F.get(F.array(*[F.lit(label) for label in labels]), order - 1)


def rounded_mean(value: Column | str, digits: int) -> Column:
    return F.round(F.avg(value), digits)


def rounded_stddev(value: Column | str, digits: int) -> Column:
    """Sample standard deviation: null for a single row."""
    return F.round(F.stddev_samp(value), digits)


def median_value(column: str) -> Column:
    """The middle value itself as a double, never an interpolation, exact at any size.

    Keeps one count per distinct value and merges them map-side: meant for votes and
    other small whole numbers. Measures with unbounded values take percentile_approx.
    """
    return F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY `{column}`)")


def scaled_ratio(part: Column, whole: Column, scale: str, digits: int = 2) -> Column:
    """``part * scale / whole`` rounded half up in decimal arithmetic, as a double."""
    return F.round(part * F.lit(Decimal(scale)) / whole, digits).cast("double")


def percentage(part: Column, whole: Column) -> Column:
    return scaled_ratio(part, whole, "100.0")
