"""The claims models: ``learning`` with the insurance tables' columns.

Policy type (multiclass) and denial (yes/no) are learnt from amount, age,
score, state and claim type; claim count and amount are forecast per month and
policy type.  Everything else is general, see ``learning``, ``metrics``,
``encoding`` and ``trees``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.functions.calendar import DEFAULT_BASE_YEAR, month_ordinal
from riskweave.operators import encoding, learning, trees
from riskweave.operators.learning import Inputs, InsufficientDataError, Models, Series, SeriesModels, Target

__all__ = [
    "CLAIM_INPUTS", "CLAIM_TARGETS", "InsufficientDataError", "claim_features", "claim_predictions", "classifier_frame", "confusion",
    "forecast_rows", "forecast_summary", "holdout_months", "node_predictions", "trend_series", "train_classifiers", "train_forecast",
]

DENIED_STATUS = "DENIED"
CLAIM_INPUTS = Inputs("claim_id", ("claim_amount", "age", "fraud_risk_score"), ("state", "claim_type"))
CLAIM_TARGETS = (
    Target("policy", "policy_type"),
    Target("denial", "claim_status", positive=DENIED_STATUS, label="is_denied", said="denied"),
)


def classifier_frame(enriched: DataFrame) -> DataFrame:
    """The claims that the models can read, and the 0/1 denial label."""
    return learning.model_rows(enriched, CLAIM_INPUTS, CLAIM_TARGETS)


def train_classifiers(enriched: DataFrame, **settings) -> Models:
    """Both forests; ``settings`` are those of ``learning.train``."""
    models = learning.train(enriched, CLAIM_INPUTS, CLAIM_TARGETS, **settings)
    models.metrics.pop("denial_f1")  # not reported for the yes/no target
    return models


def claim_predictions(
    models: Models, enriched: DataFrame, key: str = "claim_id", fraction: float = 0.1, seed: int = 42, every_row: bool = False
) -> DataFrame:
    """``gold_ml_claim_predictions``: the test rows, which no model was fitted on.

    ``every_row`` scores every modelled claim instead and adds its ``split``
    (train / test / unsampled).
    """
    rows = learning.labelled_sample(classifier_frame(enriched), key, fraction, seed)
    if not every_row:
        rows = rows.where(F.col("split") == "test").drop("split")
    return models.predictions(rows)


def claim_features(enriched: DataFrame, fraction: float = 0.1, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(features, encoder): the models' inputs of every modelled claim without a
    model object.  The encoder tables are fitted on the train rows; ``features``
    has the key, ``split``, each index, both labels and the assembled array."""
    rows = learning.labelled_sample(classifier_frame(enriched), CLAIM_INPUTS.key, fraction, seed)
    classes = [t for t in CLAIM_TARGETS if t.positive is None]
    encoder = encoding.fit_categories(rows.where(F.col("split") == "train"), [*CLAIM_INPUTS.categories, *[t.column for t in classes]])
    told = encoding.encode(rows, encoder, CLAIM_INPUTS.indexed, "keep")
    told = encoding.encode(told, encoder, {t.column: t.label_column for t in classes}, "skip")
    told = told.withColumn("features", encoding.assemble(CLAIM_INPUTS.features))
    return told.select(CLAIM_INPUTS.key, "split", *CLAIM_INPUTS.indexed.values(), *[t.label_column for t in CLAIM_TARGETS], "features"), encoder


def node_predictions(models: Models, features: DataFrame, encoder: DataFrame) -> DataFrame:
    """The predictions of ``claim_features`` rows from the models' node tables
    and the encoder table: no model object takes part in the scoring."""
    key, out = CLAIM_INPUTS.key, None
    for target in CLAIM_TARGETS:
        nodes = trees.node_table(models.forests[target.name])
        classes = nodes.agg(F.max(F.size("votes"))).first()[0]
        told = trees.score_classes(features, key, "features", nodes, trees.depth_of(nodes), classes)
        if target.positive is None:
            told = encoding.decode(told, encoder, target.column, "prediction", f"predicted_{target.output}").select(key, f"predicted_{target.output}")
        else:
            yes = (F.col("prediction") == 1.0).alias(f"predicted_{target.output}")
            told = told.select(key, yes, F.col("shares")[1].alias(f"predicted_{target.output}_probability"))
        out = told if out is None else out.join(told, key)
    return out


def confusion(predictions: DataFrame, actual: str, predicted: str, k: int | None = None) -> DataFrame:
    """Counts per (actual, predicted), largest first."""
    counts = predictions.groupBy(actual, predicted).agg(F.count("*").alias("cnt")).orderBy(F.col("cnt").desc(), actual, predicted)
    return counts.limit(k) if k else counts


def trend_series(base_year: int = DEFAULT_BASE_YEAR) -> Series:
    return Series("claim_month", "policy_type", month_ordinal("claim_month", base_year), ("claim_count", "total_claim_amount"))


def holdout_months(trends: DataFrame, holdout: int = 3) -> DataFrame:
    return learning.holdout_times(trends, "claim_month", holdout)


def train_forecast(trends: DataFrame, **settings) -> SeriesModels:
    """A regressor for the claim count and one for the amount; ``settings`` are those of ``learning.train_series``."""
    return learning.train_series(trends, trend_series(), **settings)


def forecast_rows(models: SeriesModels) -> DataFrame:
    """``gold_ml_monthly_forecast``: holdout predictions (with actuals) and one
    forward step per policy type (claim_month and actual NULL)."""
    return models.forecast()


def forecast_summary(forecast: DataFrame) -> DataFrame:
    means = [F.round(F.avg(f"{c}_value"), 2).alias(f"avg_{c}") for c in ("actual", "predicted")]
    by = ["forecast_type", "metric", "policy_type"]
    return forecast.groupBy(*by).agg(*means).orderBy(*by)
