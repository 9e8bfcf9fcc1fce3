import math

import pytest
from pyspark.sql import functions as F

from pacewell.errors import InsufficientDataError
from pacewell.functions.columns import band, clip, shown
from pacewell.operators import clean, dataset, features
from pacewell.plans import training
from pacewell.plans.scoring import features_for
from pacewell.schemas import CRITICAL, FEATURES, RECORD_COLUMNS
from pacewell.settings import SERVICES_UP_STEPS, SUCCESS_RATIO_STEPS


def one(df, c):
    return df.select(c.alias("x")).first()["x"]


def test_clip_keeps_missing(spark):
    df = spark.sql("SELECT explode(array(-1D, 0D, 12D, 24D, 25D, NULL)) AS x")
    assert [r["x"] for r in df.select(clip(F.col("x"), 0.0, 24.0).alias("x")).collect()] == [
        0.0, 0.0, 12.0, 24.0, 24.0, None]


def test_nan_counts_as_missing(spark, golden):
    nan = F.lit(float("nan"))
    assert clean.clean(golden.withColumn("sleep_hours", nan)).isEmpty()
    sensor = clean.clean(golden.withColumn("hrv", nan))
    assert sensor.count() == 15 and sensor.filter("hrv IS NOT NULL").isEmpty()
    assert features.fit_fill_values(sensor)["hrv"] == 50.0


def test_fill_values(golden):
    nulls = golden.withColumn("resting_heart_rate", F.lit(None).cast("double"))
    assert features.fit_fill_values(clean.clean(nulls))["resting_heart_rate"] == 60.0
    absent = clean.clean(golden.drop("hrv", "resting_heart_rate"))
    row = features.engineer(absent).first()
    assert (row["resting_heart_rate_filled"], row["hrv_filled"]) == (60.0, 50.0)


def test_request_features(spark):
    sample = spark.createDataFrame([(6.25, 3.0, 512.5, 2.0, 7.0, 71.0, 38.5)],
                                   [*CRITICAL, "resting_heart_rate", "hrv"])
    sample = sample.select("*")
    row = features_for(sample).first()
    assert row["sleep_recovery_ratio"] == pytest.approx(6.25 * 3 / 7.000001)
    assert row["load_stress_ratio"] == pytest.approx(512.5 / 2.000001)
    zero = sample.withColumns({"hrv": F.lit(0.0), "resting_heart_rate": F.lit(None).cast("double")})
    row = features_for(zero).first()
    assert (row["resting_heart_rate_filled"], row["hrv_filled"]) == (60.0, 50.0)
    # With fitted values a zero reading is a reading.
    row = features_for(zero, {"resting_heart_rate": 63.0, "hrv": 44.0}).first()
    assert (row["resting_heart_rate_filled"], row["hrv_filled"]) == (63.0, 0.0)


def test_serving_does_not_clip(golden):
    loud = golden.withColumn("training_load", F.lit(1500.0))
    assert features.serving_features(loud).first()["training_load"] == 1500.0


def test_feature_order(golden):
    assert features.align(features.engineer(clean.clean(golden))).columns == FEATURES


def test_too_few_labelled_rows(golden):
    with pytest.raises(InsufficientDataError) as failure:
        dataset.require_labelled(golden.limit(9))
    assert (failure.value.required, failure.value.actual) == (10, 9)
    assert dataset.require_labelled(golden.limit(10)).count() == 10


def test_hash_split_is_stable(golden):
    def sides(df):
        rows = dataset.hash_split(df, ["athlete_id", "record_date"]).collect()
        return {(r["athlete_id"], r["record_date"]): r["split"] for r in rows}

    assert sides(golden) == sides(golden.repartition(7, "hrv"))
    assert set(sides(golden).values()) <= {"train", "test"}


def test_prepare_can_fit_on_train_rows(golden):
    base = training.TrainingSettings(key_columns=("athlete_id", "record_date"))
    only = training.TrainingSettings(key_columns=("athlete_id", "record_date"), fit_on="train")
    holes = golden.withColumn("hrv", F.when(F.col("hrv") < 55, F.col("hrv")))
    rows = training.prepare(holes, only)
    train = rows.filter("split = 'train' AND hrv IS NOT NULL").select("hrv").toPandas()["hrv"]
    filled = rows.filter("hrv IS NULL").first()
    assert filled["hrv_filled"] == train.median()
    same = ["athlete_id", "record_date", "split"]
    assert training.prepare(holes, base).select(same).exceptAll(rows.select(same)).isEmpty()


def test_bands(spark):
    df = spark.range(1)
    assert [one(df, band(F.lit(v), SERVICES_UP_STEPS)) for v in (0.0, 1.0, 2.0, 3.0)] == [
        "red", "yellow", "yellow", "green"]
    assert one(df, band(F.lit(0.1), SUCCESS_RATIO_STEPS)) == "yellow"
    assert one(df, band(F.lit(None).cast("double"), SUCCESS_RATIO_STEPS)) is None


def test_shown(spark):
    df = spark.range(1)
    assert one(df, shown(F.lit(0.93164))) == "0.932"
    assert one(df, shown(F.lit(None).cast("double"))) == "N/A"
    assert one(df, shown(F.lit(math.nan))) == "N/A"


def test_columns_constant():
    assert RECORD_COLUMNS[:2] == ["athlete_id", "record_date"]
