"""Feature frame, split, fit and metrics of the helpfulness model."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from starmill.plans import helpful_model
from starmill.plans.helpful_model import FEATURES
from tests.conftest import CLEAN_REVIEWS, review, rows


def test_features(reviews_of, products_of):
    reviews = reviews_of(
        review(user="a", item="p", rating=4.0, verified=None, votes=3, length=7, year=2010),
        review(user="b", item="q", votes=None, verified=False),
        review(user="c", item="none"),
        review(user="d", rating=None),
        review(user="e", year=None),
    )
    products = products_of(("p", 3.0, ""), ("q", None, ""), ("r", 10.0, ""), ("s", 20.0, ""))
    frame = helpful_model.feature_frame(reviews, products, keys=["reviewerID"])
    assert frame.columns == ["reviewerID", *FEATURES, "is_helpful"]
    assert sorted(rows(frame)) == [
        ("a", 4.0, 0.0, 7.0, 2010.0, 3.0, 1.0),
        ("b", 5.0, 0.0, 10.0, 2012.0, 10.0, 0.0),
        ("c", 5.0, 1.0, 10.0, 2012.0, 10.0, 0.0),
    ]


def test_without_any_price_the_fill_is_zero(reviews_of, products_of):
    frame = helpful_model.feature_frame(reviews_of(review()), products_of(("i", None, "")))
    assert frame.first()["price"] == 0.0


@pytest.fixture(scope="module")
def trained(spark):
    """Long reviews are helpful: the model should find that out."""
    n = F.col("id")
    built = {
        "reviewerID": F.concat(F.lit("u"), n % 50),
        "asin": F.concat(F.lit("i"), n % 3),
        "unix_time": n,
        "rating": (n % 5 + 1).cast("double"),
        "verified": n % 2 == 0,
        "helpful_votes": F.when(n % 40 * 25 > 500, 3).otherwise(0),
        "review_length": (n % 40 * 25).cast("int"),
        "review_year": (n % 9 + 2005).cast("int"),
        "summary": F.lit(""),
        "reviewText": F.lit(""),
    }
    reviews = spark.range(2000).select(*[c.alias(name) for name, c in built.items()])
    assert reviews.columns == [c.split()[0] for c in CLEAN_REVIEWS.split(", ")]
    products = spark.createDataFrame(
        [("i0", 5.0, ""), ("i1", None, "")], "asin string, price double, brand string"
    )
    return helpful_model.train_model(reviews, products)


def test_metrics(trained):
    metrics = dict(rows(trained.metrics()))
    assert list(metrics) == [
        "model", "label_definition", "price_fill_strategy", "price_fill_value", "train_rows",
        "test_rows", "evaluated_rows", "area_under_roc", "area_under_pr", "accuracy",
        "test_positive_label_rate", "test_positive_prediction_rate", "max_iter", "reg_param",
        "elastic_net_param",
    ]
    assert int(metrics["train_rows"]) + int(metrics["test_rows"]) == 2000
    assert metrics["evaluated_rows"] == metrics["test_rows"]
    assert 0.9 < float(metrics["area_under_roc"]) <= 1
    assert 0.9 < float(metrics["area_under_pr"]) <= 1
    assert float(metrics["accuracy"]) > 0.9
    assert metrics["price_fill_value"] == "5.000000"
    assert (metrics["max_iter"], metrics["reg_param"]) == ("20", "0.010000")


def test_coefficients(trained):
    table = rows(trained.coefficients())
    assert {name for name, _, _ in table} == {*FEATURES, "intercept"}
    sizes = [size for _, _, size in table]
    assert sizes == sorted(sizes, reverse=True)
    assert dict((n, c) for n, c, _ in table)["review_length"] > 0


def test_scores(trained):
    scores = trained.scores(["reviewerID", "asin", "unix_time"])
    assert scores.count() == trained.test.count()
    assert scores.where("probability < 0 or probability > 1").count() == 0


def test_fill_strategy_without_prices(spark, trained):
    from dataclasses import replace

    metrics = dict(rows(replace(trained, price_fill=None).metrics()))
    assert metrics["price_fill_strategy"] == "fallback_zero_price"
    assert metrics["price_fill_value"] == "0.000000"


def test_areas_of_the_model_equal_mllib(trained):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    values = dict(rows(trained.metrics()))
    for name, metric in (("area_under_roc", "areaUnderROC"), ("area_under_pr", "areaUnderPR")):
        theirs = BinaryClassificationEvaluator(labelCol="is_helpful", metricName=metric, numBins=0)
        assert float(values[name]) == pytest.approx(theirs.evaluate(trained.predictions()), abs=1e-6)


def test_the_gradient_is_that_of_the_likelihood(spark):
    """Against finite differences of the regularised loss in the solver's coordinates."""
    import math
    import statistics

    n = F.col("id")
    built = [(n * (i + 3) % (7 + i) + 2000 * (i == 3)).cast("double").alias(c) for i, c in enumerate(FEATURES)]
    frame = spark.range(300).select(*built, (n % 3 == 0).cast("double").alias("is_helpful"))
    data = frame.collect()
    columns = [[r[c] for r in data] for c in FEATURES]
    centre = [statistics.fmean(c) for c in columns]
    spread = [statistics.stdev(c) for c in columns]

    def loss(scaled, shift):
        total = 0.0
        for r in data:
            z = shift + sum(b * (r[c] - m) / s for b, c, m, s in zip(scaled, FEATURES, centre, spread))
            total += math.log1p(math.exp(z)) - r["is_helpful"] * z
        return total / len(data) + 0.01 / 2 * sum(b * b for b in scaled)

    weights = [0.2, -0.1, 0.05, 0.3, -0.4]
    scaled = [w * s for w, s in zip(weights, spread)]
    shift = -0.7
    intercept = shift - sum(w * m for w, m in zip(weights, centre))
    found = dict(rows(helpful_model.likelihood_gradient(frame, weights, intercept)))
    step = 1e-5
    for i, c in enumerate(FEATURES):
        up = [b + step * (j == i) for j, b in enumerate(scaled)]
        down = [b - step * (j == i) for j, b in enumerate(scaled)]
        assert found[c] == pytest.approx((loss(up, shift) - loss(down, shift)) / (2 * step), abs=1e-7)
    slope = (loss(scaled, shift + step) - loss(scaled, shift - step)) / (2 * step)
    assert found["intercept"] == pytest.approx(slope, abs=1e-7)


def test_the_gradient_vanishes_at_the_fit_only(trained):
    found = [abs(r["gradient"]) for r in trained.gradient().collect()]
    assert max(found) < 1e-3
    weights = [float(w) * 1.3 for w in trained.model.coefficients]
    off = helpful_model.likelihood_gradient(trained.train, weights, float(trained.model.intercept))
    assert max(abs(r["gradient"]) for r in off.collect()) > 1e-2
