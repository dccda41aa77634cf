"""Which reviews do readers find helpful? A logistic regression over review features."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.operators.curves import areas_under_curves
from starmill.operators.joins import lookup_join
from starmill.operators.split import in_train
from starmill.roles import REVIEW_ROLES, Roles
from starmill.session import materialise
from starmill.sources.readers import read_table
from starmill.sources.writers import persisted, write_table

LABEL = "is_helpful"
TRAIN = "is_train"
TRAIN_FRACTION = 0.8

# Feature order, solver settings and texts of the published model.
FEATURES = ["rating", "verified_numeric", "review_length", "review_year", "price"]
SOLVER = {"maxIter": 20, "regParam": 0.01, "elasticNetParam": 0.0}
LABEL_DEFINITION = "is_helpful = 1 if helpful_votes > 0 else 0"
FILLED_WITH_MEDIAN = "median_meta_price"
FILLED_WITH_ZERO = "fallback_zero_price"


def median_price(products: DataFrame, roles: Roles = REVIEW_ROLES) -> DataFrame:
    """Approximate median over priced products, one row; null if none has a price."""
    return products.agg(
        F.percentile_approx(F.col(roles.price), 0.5, 10_000).alias("median_price")
    )


def feature_frame(
    reviews: DataFrame,
    products: DataFrame,
    roles: Roles = REVIEW_ROLES,
    keys: Sequence[str] | None = None,
    fill: Column | None = None,
) -> DataFrame:
    """Row keys, the five features and the label; rows lacking a feature are dropped.

    An unknown flag is 0, unknown votes are not helpful, and an unpriced or unknown
    product gets ``fill``: by default the median product price, or 0 without any.
    """
    if fill is None:
        fill = F.coalesce(median_price(products, roles).scalar(), F.lit(0.0))
    keys = list(keys or (roles.user, roles.item, roles.time))
    needed = [F.col(c).isNotNull() for c in (roles.score, roles.length, roles.year)]
    usable = reviews.where(needed[0] & needed[1] & needed[2]).select(
        *[F.col(k).alias(f"key_{i}") for i, k in enumerate(keys)],
        F.col(roles.item).alias("_item"),
        F.col(roles.score).cast("double").alias("rating"),
        _as_number(F.col(roles.flag)).alias("verified_numeric"),
        F.col(roles.length).cast("double").alias("review_length"),
        F.col(roles.year).cast("double").alias("review_year"),
        _as_number(F.col(roles.votes) > 0).alias(LABEL),
    )
    # Clean products hold one row per item.
    prices = products.select(
        F.col(roles.item).alias("_item"), F.col(roles.price).cast("double").alias("_price")
    )
    return lookup_join(usable, prices, "_item", "left").select(
        *[F.col(f"key_{i}").alias(k) for i, k in enumerate(keys)],
        "rating",
        "verified_numeric",
        "review_length",
        "review_year",
        F.coalesce("_price", fill).alias("price"),
        LABEL,
    )


def _as_number(condition: Column) -> Column:
    return F.when(condition, 1.0).otherwise(0.0)


def with_split(
    features: DataFrame, keys: Sequence[str | Column], fraction: float = TRAIN_FRACTION
) -> DataFrame:
    """Add 1 for training rows and 0 for test rows: a value that can name a partition."""
    return features.withColumn(TRAIN, in_train(keys, fraction).cast("int"))


def assemble(features: DataFrame) -> DataFrame:
    """Add the feature vector, skipping rows with an invalid value."""
    assembler = VectorAssembler(
        inputCols=FEATURES, outputCol="features", handleInvalid="skip"
    )
    return assembler.transform(features)


def fit(train: DataFrame) -> LogisticRegressionModel:
    """Fit on assembled rows. MLlib blocks and persists them itself, so the caller
    must not cache them a second time."""
    solver = LogisticRegression(featuresCol="features", labelCol=LABEL, **SOLVER)
    return solver.fit(train.select("features", LABEL))


@dataclass(frozen=True)
class TrainedModel:
    """A fitted model with the materialised rows it was trained and is tested on."""

    model: LogisticRegressionModel
    train: DataFrame
    test: DataFrame
    price_fill: float | None

    def predictions(self) -> DataFrame:
        return self.model.transform(self.test)

    def scores(self, keys: Sequence[str]) -> DataFrame:
        """Row keys, label, probability of the positive class and predicted class."""
        positive = vector_to_array("probability").getItem(1)
        return self.predictions().select(
            *keys, LABEL, positive.alias("probability"), "prediction"
        )

    def gradient(self) -> DataFrame:
        """The gradient over the training rows at the fitted coefficients."""
        weights = [float(w) for w in self.model.coefficients]
        return likelihood_gradient(
            self.train, weights, float(self.model.intercept), self.model.getRegParam()
        )

    def summary(self) -> DataFrame:
        return evaluation_summary(self.predictions())

    def metrics(self) -> DataFrame:
        """Metric names and values as text, in the published order. The test rows are
        scored once. Fixed values: the names and their order."""
        margin = vector_to_array("rawPrediction").getItem(1).alias("margin")
        with persisted(self.predictions().select(margin, "prediction", LABEL)) as scored:
            seen = evaluation_summary(scored).first()
            areas = areas_under_curves(scored, "margin", LABEL).first()
        strategy = FILLED_WITH_ZERO if self.price_fill is None else FILLED_WITH_MEDIAN
        rows = [
            ("model", "logistic_regression"),
            ("label_definition", LABEL_DEFINITION),
            ("price_fill_strategy", strategy),
            ("price_fill_value", f"{self.price_fill or 0.0:.6f}"),
            ("train_rows", str(self.train.count())),
            ("test_rows", str(self.test.count())),
            ("evaluated_rows", str(seen["evaluated_rows"])),
            ("area_under_roc", _fixed(areas["area_under_roc"])),
            ("area_under_pr", _fixed(areas["area_under_pr"])),
            ("accuracy", _fixed(seen["accuracy"])),
            ("test_positive_label_rate", _fixed(seen["positive_label_rate"])),
            ("test_positive_prediction_rate", _fixed(seen["positive_prediction_rate"])),
            ("max_iter", str(self.model.getMaxIter())),
            ("reg_param", f"{self.model.getRegParam():.6f}"),
            ("elastic_net_param", f"{self.model.getElasticNetParam():.6f}"),
        ]
        return self.test.sparkSession.createDataFrame(rows, "metric string, value string")

    def coefficients(self) -> DataFrame:
        """Coefficients and intercept, the largest by absolute value first."""
        weights = [float(w) for w in self.model.coefficients] + [float(self.model.intercept)]
        rows = list(zip([*FEATURES, "intercept"], weights, strict=True))
        table = self.test.sparkSession.createDataFrame(rows, "feature string, coefficient double")
        size = F.abs("coefficient").alias("abs_coefficient")
        return table.select("feature", "coefficient", size).orderBy(
            F.desc("abs_coefficient"), "feature"
        )


def _fixed(value: float | None) -> str:
    return "" if value is None else f"{value:.6f}"


def likelihood_gradient(
    features: DataFrame, weights: Sequence[float], intercept: float, reg: float = SOLVER["regParam"]
) -> DataFrame:
    """(feature, gradient) of the regularised mean log loss at given coefficients.

    In the coordinates in which the solver regularises: features centred and divided by
    their sample deviation, no penalty on the intercept. All entries are 0 at the fit, so
    they certify it without a second solver. One pass, one row per task; a feature
    without deviation has the gradient 0.
    """
    columns = dict(zip(FEATURES, weights, strict=True))
    margin = sum((F.col(c) * float(w) for c, w in columns.items()), F.lit(float(intercept)))
    off = 1 / (1 + F.exp(-margin)) - F.col(LABEL)
    measured = [F.avg("_off").alias("_off")]
    for i, c in enumerate(FEATURES):
        measured += [
            F.avg(F.col("_off") * F.col(c)).alias(f"_slope_{i}"),
            F.avg(c).alias(f"_mean_{i}"),
            F.stddev_samp(c).alias(f"_spread_{i}"),
        ]
    seen = features.withColumn("_off", off).agg(*measured)
    entries = [F.struct(F.lit("intercept").alias("feature"), F.col("_off").alias("gradient"))]
    for i, (c, w) in enumerate(columns.items()):
        spread = F.col(f"_spread_{i}")
        slope = F.col(f"_slope_{i}") - F.col("_off") * F.col(f"_mean_{i}")
        entry = F.when(spread > 0, slope / spread + reg * float(w) * spread).otherwise(0.0)
        entries.append(F.struct(F.lit(c).alias("feature"), entry.alias("gradient")))
    return seen.select(F.inline(F.array(*entries)))


def evaluation_summary(predictions: DataFrame) -> DataFrame:
    """Rows, accuracy and positive rates in one pass."""
    return predictions.agg(
        F.count("*").alias("evaluated_rows"),
        F.avg(_as_number(F.col(LABEL) == F.col("prediction"))).alias("accuracy"),
        F.avg(LABEL).alias("positive_label_rate"),
        F.avg("prediction").alias("positive_prediction_rate"),
    )


def train_model(
    reviews: DataFrame,
    products: DataFrame,
    roles: Roles = REVIEW_ROLES,
    keys: Sequence[str] | None = None,
    fraction: float = TRAIN_FRACTION,
    table_path: str | None = None,
) -> TrainedModel:
    """Build the features once as a table, then fit on the train part.

    The solver passes over its rows some twenty times; reading them from a table means
    that a lost executor never causes the join behind them to run again. The table is
    partitioned by the split, so each side reads its own files only. It is written to
    ``table_path``, or under a new name in the shared folder.
    """
    keys = list(keys or (roles.user, roles.item, roles.time))
    price_fill = median_price(products, roles).first()["median_price"]
    fill = F.lit(0.0 if price_fill is None else float(price_fill))
    features = with_split(feature_frame(reviews, products, roles, keys, fill), keys, fraction)
    if table_path is None:
        stored = materialise(features, "helpful-features", (TRAIN,))
    else:
        write_table(features, table_path, (TRAIN,))
        stored = read_table(features.sparkSession, table_path)
    table = assemble(stored)
    train, test = table.where(F.col(TRAIN) == 1), table.where(F.col(TRAIN) == 0)
    return TrainedModel(fit(train), train, test, price_fill)
