"""Means and deviations that survive a second aggregation.

A report over groups of users or products first collapses the facts to one row per user
or product: count, sum, mean and centred squares of a measure. The second aggregation
adds the squares of every row's mean around a centre, so that no large numbers cancel.

Scores take one centre for all groups (``overall_mean``), which joins nothing: safe as
long as group means lie within a few deviations of each other, as those of a bounded
scale do. Unbounded amounts, whose groups may lie far apart, take the mean of their own
group (``centred``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.operators.joins import lookup_join


class Moments:
    """Partial results of one measure under a column prefix, and the figures made of them."""

    def __init__(self, prefix: str):
        self.count_col, self.sum_col, self.mean_col, self.square_col, self.centre_col = (
            f"{prefix}_{part}" for part in ("n", "sum", "mean", "square", "centre")
        )

    def of(self, measure: str) -> list[Column]:
        """First aggregation: partial results of a measure."""
        value = F.col(measure).cast("double")
        return [
            F.count(value).alias(self.count_col),
            F.sum(value).alias(self.sum_col),
            F.avg(value).alias(self.mean_col),
            (F.var_pop(value) * F.count(value)).alias(self.square_col),
        ]

    def mean(self) -> Column:
        """Second aggregation: mean over all rows."""
        return F.try_divide(F.sum(self.sum_col), F.sum(self.count_col))

    def stddev(self, centre: Column | None = None) -> Column:
        """Second aggregation: sample standard deviation over all rows.

        Around ``centre``, the same for all rows, or after ``centred`` around the mean
        of the group. A group off the common centre is put right by its own distance.
        """
        n = F.sum(self.count_col)
        around = F.col(self.centre_col) if centre is None else centre
        apart = F.col(self.mean_col) - around
        spread = F.sum(self.square_col) + F.sum(F.col(self.count_col) * apart * apart)
        if centre is not None:
            off = self.mean() - F.max(centre)
            spread = F.greatest(spread - n * off * off, F.lit(0.0))
        return F.sqrt(F.when(n > 1, F.try_divide(spread, n - 1)))


def overall_mean(collapsed: DataFrame, measure: Moments) -> Column:
    """The mean over all collapsed rows as a scalar subquery, null without any."""
    return collapsed.agg(measure.mean()).scalar()


def centred(collapsed: DataFrame, group: str, *measures: Moments) -> DataFrame:
    """Collapsed rows with the mean of their group, one small aggregate joined back.

    ``group`` must not be null. A group may hold most collapsed rows, so the join is one
    that splits hot keys.
    """
    centres = collapsed.groupBy(group).agg(*[m.mean().alias(m.centre_col) for m in measures])
    return lookup_join(collapsed, centres, group)
