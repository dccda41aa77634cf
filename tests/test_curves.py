"""Areas from running counts against MLlib's over all thresholds."""

from __future__ import annotations

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from starmill.operators.curves import areas_under_curves, running_counts
from tests.conftest import plan, rows

METRICS = ("areaUnderROC", "areaUnderPR")


def mllib(scored):
    """Without binning, so that every score is a threshold."""
    return [
        BinaryClassificationEvaluator(
            labelCol="y", rawPredictionCol="s", metricName=m, numBins=0
        ).evaluate(scored)
        for m in METRICS
    ]


@pytest.mark.parametrize("distinct", [2, 37, 5000])
def test_areas_equal_mllib(spark, distinct):
    n = F.col("id")
    score = (F.pmod(F.xxhash64("id"), F.lit(distinct)) / 7.0).cast("double")
    noisy = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(distinct)) / 7.0
    scored = spark.range(4000).select(score.alias("s"), (noisy < score).cast("double").alias("y"), n)
    found = areas_under_curves(scored.repartition(6), "s", "y").first()
    assert [found.area_under_roc, found.area_under_pr] == pytest.approx(mllib(scored), abs=1e-9)
    assert found.evaluated_rows == 4000


def test_running_counts_continue_across_ranges(spark):
    scored = spark.range(1000).select((F.col("id") % 100).alias("s"), (F.col("id") % 3).alias("y"))
    counted = running_counts(scored, "s", "y").orderBy(F.desc("score"))
    pos = neg = 0
    for r in counted.collect():
        assert (r.pos_before, r.neg_before) == (pos, neg)
        pos, neg = pos + r.pos, neg + r.neg
    assert pos + neg == 1000


def test_scores_are_scanned_once(spark, tmp_path, monkeypatch):
    """The scores enter one aggregation; all else works on distinct scores."""
    from starmill.operators import curves

    kept = []
    monkeypatch.setattr(curves, "materialise", lambda df, label: kept.append(df) or df)
    spark.range(500).select((F.col("id") % 50).alias("s"), (F.col("id") % 2).alias("y")).write.parquet(
        str(tmp_path / "scores")
    )
    running_counts(spark.read.parquet(str(tmp_path / "scores")), "s", "y")
    assert plan(kept[0]).count("FileScan parquet") == 1


def test_nulls_one_class_and_no_rows(spark):
    scored = spark.createDataFrame([(1.0, 1), (None, 0), (2.0, None), (3.0, 1)], "s double, y int")
    assert rows(areas_under_curves(scored, "s", "y")) == [(2, 2, None, None)]
    assert rows(areas_under_curves(scored.limit(0), "s", "y")) == [(0, 0, None, None)]
    only = spark.createDataFrame([(1.0, 0)], "s double, y int")
    assert rows(areas_under_curves(only, "s", "y")) == [(1, 0, None, None)]
