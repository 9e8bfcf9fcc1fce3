"""Scoring: requests to logged predictions and rounded answers."""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pacewell.operators.features import request_defaults, serving_features
from pacewell.plans import model as models
from pacewell.plans.published import CurrentModel
from pacewell.schemas import FEATURES, SENSORS
from pacewell.settings import MODEL_VERSION, SERVING_DEFAULTS
from pacewell.sources.tables import append_predictions, load_predictions, prediction_rows


def features_for(requests: DataFrame, fill_values: dict[str, float] | None = None) -> DataFrame:
    """Request defaults and serving features.

    Without ``fill_values`` the constants are used and a zero sensor counts as
    missing. With fitted medians only missing sensors are filled.
    """
    if fill_values is None:
        requests = request_defaults(requests)
    else:
        requests = requests.withColumns({
            c: F.coalesce(F.col(c), F.lit(fill_values[c])) if c in requests.columns
            else F.lit(fill_values[c]) for c in SENSORS})
    return serving_features(requests, fill_values)


def score_with(model, requests: DataFrame, fill_values=None, partitions: int | None = None) -> DataFrame:
    """Adds ``prediction``. Walking the trees is the costly part of a row, so
    ``partitions`` deals the requests out where the input has too few."""
    ready = features_for(requests, fill_values)
    if partitions is not None:
        ready = models.dealt(ready, partitions, FEATURES)
    return models.score_in_batches(model, ready)


def answers(rows: DataFrame) -> DataFrame:
    """What the caller of a prediction sees."""
    return rows.select("athlete_id", "prediction_date",
                       models.rounded("performance_score").alias("performance_score"),
                       "model_version")


def score_job(requests: DataFrame, model_path: str, log_path: str | None = None,
              fill_values: dict[str, float] | None = None,
              version: str = MODEL_VERSION, partitions: int | None = None) -> DataFrame:
    """Scores a batch and returns the answers.

    With a log the trees are walked once: the batch is appended under an id of
    its own, and the answers are those log rows.
    """
    rows = prediction_rows(score_with(models.load(model_path), requests, fill_values, partitions),
                           version=version)
    return _logged(rows, log_path)


def _logged(rows: DataFrame, log_path: str | None) -> DataFrame:
    if not log_path:
        return answers(rows)
    batch = uuid.uuid4().hex
    append_predictions(rows, log_path, batch)
    return answers(load_predictions(rows.sparkSession, log_path, batch))


def score_published(requests: DataFrame, root: str, log_path: str | None = None,
                    fill_values: dict[str, float] | None = None, partitions: int | None = None) -> DataFrame:
    """``score_job`` with the version that is current when the job starts; every row carries it."""
    version, model = CurrentModel(requests.sparkSession, root).get()
    return _logged(prediction_rows(score_with(model, requests, fill_values, partitions), version=version), log_path)


def score_record(spark: SparkSession, model_path: str, features: dict[str, float],
                 fill_values: dict[str, float] | None = None,
                 version: str = MODEL_VERSION) -> tuple[float, str]:
    """One request through the batch path: rounded score and model version."""
    row = spark.createDataFrame(
        [tuple(None if features.get(c) is None else float(features[c]) for c in SERVING_DEFAULTS)],
        ", ".join(f"{c} double" for c in SERVING_DEFAULTS))
    scored = models.score(models.load(model_path), features_for(row, fill_values))
    return scored.select(models.rounded().alias("score")).first()["score"], version
