"""Imputation and derived features, for training and for serving."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacewell.functions.columns import (
    default_if_falsy,
    default_if_missing,
    load_stress_ratio,
    nan_to_null,
    sleep_recovery_ratio,
)
from pacewell.operators.order_stats import exact_medians
from pacewell.schemas import CRITICAL, FEATURES, SENSORS
from pacewell.settings import ABSENT_SENSOR_VALUES, CLIP_BOUNDS, SERVING_DEFAULTS


def fit_fill_values(cleaned: DataFrame) -> dict[str, float]:
    """Fill value per sensor: the median of what was measured.

    A sensor the frame lacks, or that has no reading at all, gets its constant.
    """
    present = {c: CLIP_BOUNDS[c] for c in SENSORS if c in cleaned.columns}
    medians = exact_medians(cleaned, present) if present else {}
    return {c: ABSENT_SENSOR_VALUES[c] if medians.get(c) is None else medians[c] for c in SENSORS}


def fill_sensors(df: DataFrame, values: dict[str, float]) -> DataFrame:
    """Adds ``*_filled`` columns. The values are literals, so nothing is joined."""
    return df.withColumns({
        f"{c}_filled": F.coalesce(nan_to_null(F.col(c)), F.lit(values[c]))
        if c in df.columns else F.lit(values[c])
        for c in SENSORS
    })


def add_ratios(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "sleep_recovery_ratio": sleep_recovery_ratio(
            F.col("sleep_hours"), F.col("sleep_quality"), F.col("recovery_score")),
        "load_stress_ratio": load_stress_ratio(F.col("training_load"), F.col("stress_level")),
    })


def engineer(cleaned: DataFrame, fill_values: dict[str, float] | None = None) -> DataFrame:
    """All training features. Without given fill values they are fitted here."""
    values = fit_fill_values(cleaned) if fill_values is None else fill_values
    return add_ratios(fill_sensors(cleaned, values))


def request_defaults(df: DataFrame, defaults=SERVING_DEFAULTS) -> DataFrame:
    """Optional request fields: missing or zero becomes the default."""
    return df.withColumns({c: default_if_falsy(F.col(c), defaults[c])
                           if c in df.columns else F.lit(defaults[c]) for c in SENSORS})


def serving_features(df: DataFrame, fill_values: dict[str, float] | None = None) -> DataFrame:
    """Features for scoring: defaults for every input, no clipping.

    ``fill_values`` replaces the sensor constants by fitted medians.
    """
    defaults = {**SERVING_DEFAULTS, **(fill_values or {})}

    def value(c):
        return default_if_missing(F.col(c), defaults[c]) if c in df.columns else F.lit(defaults[c])

    filled = df.withColumns(
        {c: value(c) for c in CRITICAL} | {f"{c}_filled": value(c) for c in SENSORS})
    return add_ratios(filled)


def align(df: DataFrame, *others: str) -> DataFrame:
    """The nine features in model order, after any other wanted columns."""
    return df.select(*others, *FEATURES)
