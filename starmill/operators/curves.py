"""Areas under the ROC and precision-recall curves from one scan of the scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmill.session import materialise


def running_counts(scored: DataFrame, score: str, label: str) -> DataFrame:
    """Per distinct score, highest first: positives and negatives, and those before it.

    The scores are read once and collapse to distinct values. These are cut into ranges;
    each range's totals, a row per range, give what lies before it, and the running
    counts inside a range start from there. No task sorts more than a range.
    """
    positive = F.col(label) > 0
    distinct = (
        scored.where(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(score).cast("double").alias("score"))
        .agg(F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg"))
    )
    # Written once: the borders of the ranges must be the same for totals and rows.
    ranges = materialise(
        distinct.repartitionByRange(F.desc("score")).withColumn("_range", F.spark_partition_id()),
        "score-ranges",
    )
    totals = ranges.groupBy("_range").agg(F.sum("pos").alias("_pos"), F.sum("neg").alias("_neg"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_range",
        F.coalesce(F.sum("_pos").over(earlier), F.lit(0)).alias("_pos"),
        F.coalesce(F.sum("_neg").over(earlier), F.lit(0)).alias("_neg"),
    )
    inside = Window.partitionBy("_range").orderBy(F.desc("score"))
    above = inside.rowsBetween(Window.unboundedPreceding, -1)
    return ranges.join(F.broadcast(offsets), "_range").select(
        "score",
        "pos",
        "neg",
        (F.col("_pos") + F.coalesce(F.sum("pos").over(above), F.lit(0))).alias("pos_before"),
        (F.col("_neg") + F.coalesce(F.sum("neg").over(above), F.lit(0))).alias("neg_before"),
    )


def areas_under_curves(scored: DataFrame, score: str, label: str) -> DataFrame:
    """One row: scored rows, positives and both areas by the trapezoid rule.

    Labels above 0 are positive; rows without score or label take no part. Equal scores
    are one threshold. The precision-recall curve starts at recall 0 with the precision
    of the highest score. An area without positives or without negatives is null.
    """
    counts = running_counts(scored, score, label)
    pos, neg = F.col("pos"), F.col("neg")
    seen, before = F.col("pos_before") + pos, F.col("pos_before")
    precision = seen / (seen + F.col("neg_before") + neg)
    earlier = F.coalesce(F.try_divide(before, before + F.col("neg_before")), precision)
    all_pos, all_neg = F.sum("pos"), F.sum("neg")
    roc = F.sum(neg.cast("double") * (before + pos / 2))
    return counts.agg(
        F.coalesce(all_pos + all_neg, F.lit(0)).alias("evaluated_rows"),
        F.coalesce(all_pos, F.lit(0)).alias("positives"),
        F.try_divide(roc, all_pos.cast("double") * all_neg).alias("area_under_roc"),
        F.when(all_neg > 0, F.try_divide(F.sum(pos * (precision + earlier) / 2), all_pos)).alias(
            "area_under_pr"
        ),
    )
