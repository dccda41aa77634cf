"""The helpfulness model over order lines as reviews and parts as products."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from starmill.catalog.bindings import (
    LINE_REVIEWS,
    PART_PRODUCTS,
    line_reviews,
    part_products,
)
from starmill.catalog.registry import query
from starmill.operators.curves import areas_under_curves
from starmill.operators.split import in_train
from starmill.plans import helpful_model
from starmill.plans.helpful_model import FEATURES, LABEL

KEYS = ["reviewerID", "asin", "unix_time"]

ML_FEATURES = f"""
    SELECT "reviewerID", asin, unix_time, rating,
           CASE WHEN verified THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS verified_numeric,
           CAST(review_length AS DOUBLE) AS review_length,
           CAST(review_year AS DOUBLE) AS review_year,
           COALESCE(price, (SELECT quantile_disc(price, 0.5) FROM ({PART_PRODUCTS})), 0.0)
               AS price,
           CASE WHEN helpful_votes > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS is_helpful
    FROM ({LINE_REVIEWS}) LEFT JOIN ({PART_PRODUCTS}) USING (asin)
    WHERE rating IS NOT NULL AND review_length IS NOT NULL AND review_year IS NOT NULL
"""

IS_TRAIN = """
    CAST(md5(concat_ws('|', "reviewerID", asin, unix_time)) < 'cccccccd' AS INTEGER)
"""


def _features(spark, sf_dir):
    return helpful_model.feature_frame(
        line_reviews(spark, sf_dir), part_products(spark, sf_dir), keys=KEYS
    )


def _trained(spark, sf_dir):
    return helpful_model.train_model(
        line_reviews(spark, sf_dir), part_products(spark, sf_dir), keys=KEYS
    )


@query("ml_features", ML_FEATURES)
def ml_features(spark, sf_dir):
    return _features(spark, sf_dir)


@query(
    "hash_split",
    f"""
    SELECT "reviewerID", asin, unix_time, {IS_TRAIN} AS is_train FROM ({LINE_REVIEWS})
    """,
)
def hash_split(spark, sf_dir):
    reviews = line_reviews(spark, sf_dir)
    return reviews.select(*KEYS, in_train(KEYS).cast("int").alias("is_train"))


@query(
    "ml_split_counts",
    f"""
    SELECT {IS_TRAIN} AS is_train, COUNT(*) AS "rows", ROUND(AVG(is_helpful), 6) AS helpful_rate,
           ROUND(AVG(price), 4) AS avg_price
    FROM ({ML_FEATURES}) GROUP BY 1
    """,
)
def ml_split_counts(spark, sf_dir):
    split = helpful_model.with_split(_features(spark, sf_dir), KEYS)
    return split.groupBy("is_train").agg(
        F.count("*").alias("rows"),
        F.round(F.avg(LABEL), 6).alias("helpful_rate"),
        F.round(F.avg("price"), 4).alias("avg_price"),
    )


@query(
    "ml_assemble",
    f"""
    SELECT "reviewerID", asin, unix_time, is_helpful,
           {", ".join(f"{name} AS feature_{i}" for i, name in enumerate(FEATURES))}
    FROM ({ML_FEATURES})
    """,
)
def ml_assemble(spark, sf_dir):
    vector = vector_to_array("features")
    positions = [vector.getItem(i).alias(f"feature_{i}") for i in range(len(FEATURES))]
    return helpful_model.assemble(_features(spark, sf_dir)).select(*KEYS, LABEL, *positions)


AREAS = f"""
    WITH thresholds AS (
        SELECT review_length AS score, COUNT(*) FILTER (WHERE is_helpful > 0) AS pos,
               COUNT(*) FILTER (WHERE is_helpful = 0) AS neg
        FROM ({ML_FEATURES}) GROUP BY review_length
    ), curve AS (
        SELECT *, SUM(pos) OVER down AS tp, SUM(neg) OVER down AS fp,
               SUM(pos) OVER () AS p, SUM(neg) OVER () AS n
        FROM thresholds WINDOW down AS (ORDER BY score DESC)
    ), points AS (
        SELECT *, CAST(tp AS DOUBLE) / (tp + fp) AS precision,
               lag(CAST(tp AS DOUBLE) / (tp + fp)) OVER (ORDER BY score DESC) AS earlier
        FROM curve
    )
    SELECT CAST(MAX(p + n) AS BIGINT) AS evaluated_rows, CAST(MAX(p) AS BIGINT) AS positives,
           ROUND(SUM(neg * (tp - pos / 2.0::DOUBLE)) / MAX(CAST(p AS DOUBLE) * n), 9) AS area_under_roc,
           ROUND(SUM(pos * (precision + COALESCE(earlier, precision)) / 2) / MAX(p), 9) AS area_under_pr
    FROM points
"""


@query("ml_areas", AREAS)
def ml_areas(spark, sf_dir):
    """How well the length alone tells helpful reviews from others."""
    areas = areas_under_curves(_features(spark, sf_dir), "review_length", LABEL)
    rounded = [F.round(c, 9).alias(c) for c in ("area_under_roc", "area_under_pr")]
    return areas.select("evaluated_rows", "positives", *rounded)


# Any coefficients will do: the gradient there is as good a test as at the fit.
STATED_WEIGHTS = {
    "rating": -0.3, "verified_numeric": -0.5, "review_length": 0.001, "review_year": -0.01, "price": 0.002
}
STATED_INTERCEPT = 20.0
GRADIENT_TOLERANCE = 1e-3
MARGIN = " + ".join(f"({w}) * {c}" for c, w in STATED_WEIGHTS.items())
SLOPES = " UNION ALL ".join(
    f"""
    SELECT '{c}' AS feature,
           ROUND((AVG(off * {c}) - AVG(off) * AVG({c})) / STDDEV_SAMP({c})
                 + 0.01 * ({w}) * STDDEV_SAMP({c}), 8) AS gradient
    FROM errors
    """
    for c, w in STATED_WEIGHTS.items()
)


@query(
    "ml_gradient",
    f"""
    WITH errors AS (
        SELECT *, 1 / (1 + exp(-({MARGIN} + {STATED_INTERCEPT}))) - is_helpful AS off
        FROM ({ML_FEATURES}) WHERE {IS_TRAIN.strip()} = 1
    )
    SELECT 'intercept' AS feature, ROUND(AVG(off), 8) AS gradient FROM errors UNION ALL {SLOPES}
    """,
)
def ml_gradient(spark, sf_dir):
    """The gradient of the regularised likelihood at stated coefficients."""
    train = helpful_model.with_split(_features(spark, sf_dir), KEYS).where("is_train = 1")
    weights = [STATED_WEIGHTS[c] for c in FEATURES]
    entries = helpful_model.likelihood_gradient(train, weights, STATED_INTERCEPT)
    return entries.select("feature", F.round("gradient", 8).alias("gradient"))


@query(
    "ml_gradient_check",
    f"""
    SELECT COUNT(*) AS train_rows, {GRADIENT_TOLERANCE}::DOUBLE AS tolerance, true AS optimal
    FROM ({ML_FEATURES}) WHERE {IS_TRAIN.strip()} = 1
    """,
)
def ml_gradient_check(spark, sf_dir):
    """The fit is where the gradient vanishes: its norm there is below the tolerance."""
    trained = _trained(spark, sf_dir)
    norm = trained.gradient().agg(F.sqrt(F.sum(F.col("gradient") * F.col("gradient")))).scalar()
    return trained.train.agg(F.count("*").alias("train_rows")).select(
        "train_rows",
        F.lit(GRADIENT_TOLERANCE).alias("tolerance"),
        (norm < GRADIENT_TOLERANCE).alias("optimal"),
    )


@query("ml_fit")
def ml_fit(spark, sf_dir):
    trained = _trained(spark, sf_dir)
    return trained.coefficients().select("feature", "coefficient")


@query("ml_predict")
def ml_predict(spark, sf_dir):
    return _trained(spark, sf_dir).scores(KEYS)


@query("ml_eval_summary")
def ml_eval_summary(spark, sf_dir):
    return _trained(spark, sf_dir).summary()


@query("ml_metrics")
def ml_metrics(spark, sf_dir):
    return _trained(spark, sf_dir).metrics()


@query("ml_coefficients")
def ml_coefficients(spark, sf_dir):
    return _trained(spark, sf_dir).coefficients()


@query(
    "ml_test_rates",
    f"""
    SELECT COUNT(*) AS evaluated_rows, ROUND(AVG(is_helpful), 6) AS positive_label_rate
    FROM ({ML_FEATURES}) WHERE {IS_TRAIN.strip()} = 0
    """,
)
def ml_test_rates(spark, sf_dir):
    seen = _trained(spark, sf_dir).summary()
    rate = F.round("positive_label_rate", 6).alias("positive_label_rate")
    return seen.select("evaluated_rows", rate)


@query(
    "ml_score_check",
    f"""
    SELECT COUNT(*) AS rows_scored, 0::BIGINT AS rows_off
    FROM ({ML_FEATURES}) WHERE {IS_TRAIN.strip()} = 0
    """,
)
def ml_score_check(spark, sf_dir):
    """Stored probabilities against those recomputed from the coefficients."""
    trained = _trained(spark, sf_dir)
    weights = dict(zip(FEATURES, map(float, trained.model.coefficients)))
    margin = sum((F.col(c) * w for c, w in weights.items()), F.lit(float(trained.model.intercept)))
    own = 1 / (1 + F.exp(-margin))
    stored = vector_to_array("probability").getItem(1)
    return trained.predictions().agg(
        F.count("*").alias("rows_scored"), F.count_if(F.abs(own - stored) > 1e-9).alias("rows_off")
    )
