"""Table schemas and column groups. Nothing here is inferred from data."""

from pyspark.sql import types as T

CRITICAL = ["sleep_hours", "sleep_quality", "training_load", "stress_level", "recovery_score"]
OPTIONAL = ["resting_heart_rate", "hrv", "performance_score"]
SENSORS = ["resting_heart_rate", "hrv"]
LABEL = "performance_score"

REQUIRED = ["athlete_id", "record_date", *CRITICAL]
RECORD_COLUMNS = [*REQUIRED, *OPTIONAL]

# Column order the model is fitted and scored in.
FEATURES = [
    "sleep_hours",
    "sleep_quality",
    "training_load",
    "stress_level",
    "recovery_score",
    "resting_heart_rate_filled",
    "hrv_filled",
    "sleep_recovery_ratio",
    "load_stress_ratio",
]

_DOUBLES = [*CRITICAL, *OPTIONAL]

RECORD = T.StructType(
    [T.StructField("athlete_id", T.StringType()), T.StructField("record_date", T.DateType())]
    + [T.StructField(c, T.DoubleType()) for c in _DOUBLES]
)


PERFORMANCE = T.StructType(
    [T.StructField("id", T.StringType())]
    + RECORD.fields
    + [T.StructField("created_at", T.TimestampType())]
)

PREDICTIONS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("athlete_id", T.StringType()),
        T.StructField("prediction_date", T.DateType()),
        T.StructField("performance_score", T.DoubleType()),
        T.StructField("features_used", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("model_version", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)

TRAINING_RUNS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("run_date", T.TimestampType()),
        T.StructField("model_version", T.StringType()),
        T.StructField("samples_used", T.LongType()),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("status", T.StringType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
    ]
)

REQUEST_LOG = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("job", T.StringType()),
        T.StructField("method", T.StringType()),
        T.StructField("endpoint", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("duration", T.DoubleType()),
    ]
)
