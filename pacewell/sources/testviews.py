"""The driver's tables seen through the data model.

The expressions are plain SQL that Spark and DuckDB read alike; the oracle
queries use the same text.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pacewell.operators.observability import up_samples as up_from_log
from pacewell.operators.timeline import running_number
from pacewell.settings import SERVICES

PERF_RAW = {
    "record_key": "concat_ws('-', CAST(l_orderkey AS VARCHAR(20)), CAST(l_partkey AS VARCHAR(20)), "
                  "CAST(l_suppkey AS VARCHAR(20)), CAST(l_linenumber AS VARCHAR(20)))",
    "athlete_id": "concat('athlete_', lpad(CAST(l_suppkey AS VARCHAR(20)), 5, '0'))",
    "record_date": "CAST(l_shipdate AS DATE)",
    "sleep_hours": "CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE l_quantity * CAST(0.5 AS DOUBLE) END",
    "sleep_quality": "1 + l_discount * 100",
    "training_load": "l_extendedprice / 100",
    "stress_level": "1 + l_tax * 125",
    "recovery_score": "l_linenumber * CAST(1.5 AS DOUBLE)",
    "resting_heart_rate": "CASE WHEN l_returnflag = 'R' THEN NULL "
                          "ELSE CAST(25 + l_partkey % 100 AS DOUBLE) END",
    "hrv": "CASE WHEN l_returnflag = 'A' THEN NULL ELSE l_quantity * CAST(4.2 AS DOUBLE) END",
    "performance_score": "CASE WHEN l_linestatus = 'O' THEN NULL ELSE least(CAST(100 AS DOUBLE), "
                         "greatest(CAST(0 AS DOUBLE), 40 + 3 * (1 + l_discount * 100) "
                         "- 2 * (1 + l_tax * 125) + l_quantity * CAST(0.5 AS DOUBLE) "
                         "+ l_linenumber * 2 - l_extendedprice / 5000)) END",
}

PREDICTIONS = {
    "id": "event_id",
    "athlete_id": "concat('athlete_', lpad(CAST(user_id AS VARCHAR(20)), 5, '0'))",
    "prediction_date": "CAST(ts AS DATE)",
    "performance_score": "least(CAST(100 AS DOUBLE), value)",
    "features_used": "props",
    "model_version": "CASE WHEN event_id % 3 = 0 THEN '1.1' ELSE '1.0' END",
    "created_at": "ts",
}

TRAINING_RUNS = {
    "id": "event_id",
    "run_date": "ts",
    "model_version": PREDICTIONS["model_version"],
    "samples_used": "10 + event_id",
    "status": "'completed'",
    "metrics": "concat('{\"train_mae\":', CAST(CAST(floor(value) AS BIGINT) AS VARCHAR(20)), "
               "CASE WHEN user_id % 5 = 0 THEN '' ELSE concat("
               "',\"test_mae\":', CAST(CAST(floor(value * 2) AS BIGINT) AS VARCHAR(20)), "
               "',\"test_rmse\":', CAST(CAST(floor(value * 3) AS BIGINT) AS VARCHAR(20)), "
               "',\"test_r2\":0.', CAST(user_id % 10 AS VARCHAR(20))) END, '}')",
}
TRAINING_RUNS_WHERE = "event_type = 'error'"

REQUEST_LOG = {
    "event_id": "event_id",
    "ts": "CAST(ts AS TIMESTAMP)",
    "job": "CASE WHEN event_type = 'signup' THEN 'data-ingestion' "
           "WHEN event_type = 'error' AND user_id % 2 = 0 THEN 'ml-trainer' ELSE 'api' END",
    "method": "CASE WHEN event_type IN ('click', 'view') THEN 'GET' ELSE 'POST' END",
    "endpoint": "CASE event_type WHEN 'purchase' THEN '/predict' WHEN 'signup' THEN '/v1/ingest' "
                "WHEN 'click' THEN '/dashboard/predictions' WHEN 'view' THEN '/health/live' "
                "ELSE CASE WHEN user_id % 2 = 0 THEN '/v1/train' ELSE '/train' END END",
    "status": "CASE WHEN value >= 150 THEN '500' ELSE '200' END",
    "duration": "value / 100",
}

# Score that stands in for a model where a result must be checkable in SQL.
FORMULA_SCORE = "40 + 3 * sleep_quality - 2 * stress_level"


def _projected(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{text} AS {name}" for name, text in columns.items()])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as a stream of files; the pattern matches its name exactly."""
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


def as_perf_raw(lineitem: DataFrame) -> DataFrame:
    return _projected(lineitem, PERF_RAW)


def as_request_log(events: DataFrame) -> DataFrame:
    return _projected(events, REQUEST_LOG)


def perf_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_perf_raw(table(spark, sf_dir, "lineitem"))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _projected(table(spark, sf_dir, "events"), PREDICTIONS)


def training_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _projected(table(spark, sf_dir, "events").filter(TRAINING_RUNS_WHERE), TRAINING_RUNS)


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_request_log(table(spark, sf_dir, "events"))


def up_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return up_from_log(request_log(spark, sf_dir), 3600, SERVICES)


def counter_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters that restart every day, one sample per request."""
    log = request_log(spark, sf_dir).withColumn("day", F.to_date("ts"))
    labels = ["job", "method", "endpoint", "status"]
    return running_number(log, [*labels, "day"], "ts", ["event_id"], name="v").drop("day")
