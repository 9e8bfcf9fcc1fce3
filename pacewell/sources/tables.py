"""The three stored tables: append sinks and scans.

Appends only; repeated records are kept. A table exists after its first
append. Ids are random UUIDs: a shared sequence would serialise all writers.
"""

from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pacewell.schemas import (
    PERFORMANCE,
    PREDICTIONS,
    RECORD_COLUMNS,
    TRAINING_RUNS,
)
from pacewell.settings import MODEL_VERSION, SERVING_DEFAULTS

MONTH = "record_month"
BATCH = "batch"


def _stamped(df: DataFrame) -> DataFrame:
    return df.withColumns({"id": F.expr("uuid()"), "created_at": F.current_timestamp()})


def _shaped(df: DataFrame, schema) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def performance_rows(records: DataFrame) -> DataFrame:
    """Records as rows of the performance table."""
    return _shaped(_stamped(records), PERFORMANCE)


def append_performance(records: DataFrame, path: str, by_month: bool = False) -> int:
    """Appends records and returns their number, counted while writing.

    ``by_month`` lays the table out by month of ``record_date``. The rebalance
    hint lets Spark split a month that is too large for one task. Ids are given
    after that shuffle, so that a repeated task cannot hand one out twice.
    """
    seen = Observation()
    if by_month:
        records = records.withColumn(MONTH, F.date_format("record_date", "yyyy-MM"))
        records = records.hint("rebalance", MONTH)
        month = [F.col(MONTH)]
    else:
        month = []
    rows = _stamped(records).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in PERFORMANCE.fields], *month)
    writer = rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append")
    (writer.partitionBy(MONTH) if by_month else writer).parquet(path)
    return seen.get["n"]


def load_performance(spark: SparkSession, path: str, since: date | None = None,
                     until: date | None = None) -> DataFrame:
    """The ten record columns; date bounds prune months where there are any."""
    df = spark.read.parquet(path)
    for bound, keep in ((since, "__ge__"), (until, "__le__")):
        if bound is not None:
            df = df.filter(getattr(F.col("record_date"), keep)(F.lit(bound)))
            if MONTH in df.columns:
                df = df.filter(getattr(F.col(MONTH).cast("string"), keep)(F.lit(bound.strftime("%Y-%m"))))
    return df.select(*RECORD_COLUMNS)


def prediction_rows(scored: DataFrame, score: str = "prediction",
                    version: str = MODEL_VERSION) -> DataFrame:
    """Prediction rows with the scoring inputs as a feature map, unrounded."""
    pairs = [x for c in SERVING_DEFAULTS for x in (F.lit(c), F.col(c).cast("double"))]
    return scored.select(
        "athlete_id", "prediction_date", F.col(score).alias("performance_score"),
        F.create_map(*pairs).alias("features_used"), F.lit(version).alias("model_version"))


def log_rows(rows: DataFrame) -> DataFrame:
    """Prediction rows as rows of the prediction log."""
    return _shaped(_stamped(rows), PREDICTIONS)


def append_predictions(rows: DataFrame, path: str, batch: str = "unnamed") -> int:
    """Appends to the log; each batch is a folder, so that it can be read alone."""
    seen = Observation()
    logged = log_rows(rows).observe(seen, F.count(F.lit(1)).alias("n")).withColumn(BATCH, F.lit(batch))
    logged.write.mode("append").partitionBy(BATCH).parquet(path)
    return seen.get["n"]


def load_predictions(spark: SparkSession, path: str, batch: str | None = None) -> DataFrame:
    """The log, or one of its batches."""
    if batch is not None:
        return spark.read.schema(PREDICTIONS).parquet(f"{path}/{BATCH}={batch}")
    return spark.read.option("recursiveFileLookup", True).schema(PREDICTIONS).parquet(path)


def append_training_run(spark: SparkSession, path: str, samples_used: int,
                        metrics: dict[str, float], version: str = MODEL_VERSION,
                        status: str = "completed", error_message: str | None = None) -> None:
    row = spark.createDataFrame(
        [(version, samples_used, metrics, status, error_message)],
        "model_version string, samples_used long, metrics map<string,double>, "
        "status string, error_message string")
    run = _stamped(row).withColumn("run_date", F.col("created_at"))
    _shaped(run, TRAINING_RUNS).coalesce(1).write.mode("append").parquet(path)


def load_training_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(TRAINING_RUNS).parquet(path)
