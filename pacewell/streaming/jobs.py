"""Streams over files. All take a checkpoint folder and end when caught up,
unless another trigger is given.

Batch sinks write each micro-batch to a folder named by its id and overwrite
it, so a batch that is repeated after a failure leaves no second copy.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from pacewell.errors import ValidationError
from pacewell.functions.histogram import bucket_columns, cumulative_counts, quantile
from pacewell.operators.alerts import evaluate
from pacewell.operators.intake import coerce, split_batches, split_valid
from pacewell.operators.observability import fully_matches
from pacewell.operators.timeline import closing_state
from pacewell.plans import model as models
from pacewell.plans.published import CurrentModel
from pacewell.plans.scoring import score_with
from pacewell.settings import LATENCY_BOUNDS, MODEL_VERSION, SERVING_DEFAULTS, AlertRule
from pacewell.sources.files import LINE, SOURCE_FILE, csv_lines, json_reader, json_records, numbered, records_of_lines
from pacewell.sources.tables import log_rows, performance_rows, prediction_rows

CAUGHT_UP = {"availableNow": True}


def batch_path(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}"


def csv_stream(spark: SparkSession, path: str, max_files: int | None = None, recursive: bool = False) -> DataFrame:
    """Lines of arriving CSV files; ``intake_stream`` parses them by their own files' headers."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return csv_lines(reader, path, recursive)


def json_stream(spark: SparkSession, path: str, max_files: int | None = None, multi_line: bool = False) -> DataFrame:
    """Records of JSON batch documents as text, damaged documents included."""
    reader = json_reader(spark.readStream, multi_line)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return json_records(reader.json(path))


def intake_stream(records: DataFrame, good_path: str, bad_path: str, checkpoint: str,
                  profile: str = "ingest", trigger=None, whole_files: bool = False):
    """Coerces and validates records; good and bad rows go to two tables.

    Lines of CSV files are parsed by the header of their own file, which always
    is in the same micro-batch. With ``whole_files`` one bad record refuses its
    whole file, and ``bad_path`` lists the refused files.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        lines = numbered(batch).persist(StorageLevel.MEMORY_AND_DISK) if LINE in batch.columns else None
        try:
            typed = coerce(batch if lines is None else records_of_lines(lines), strict=False)
            # The two filters read the micro-batch twice; a cached copy of
            # records would cost more than the second, cheap pass.
            good, bad = split_batches(typed, [SOURCE_FILE], profile, few=True) if whole_files else split_valid(typed, profile)
            for rows, path in ((performance_rows(good), good_path), (bad, bad_path)):
                rows.write.mode("overwrite").parquet(batch_path(path, batch_id))
        finally:
            if lines is not None:
                lines.unpersist()

    return (records.writeStream.foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or CAUGHT_UP)).start())


def watermarked(log: DataFrame, late: str, ts: str = "ts") -> DataFrame:
    """Event time with a bound for late rows; needs an instant, not a wall time."""
    return log.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)


def _window(width: int, slide: int | None):
    return F.window("ts", f"{width} seconds", f"{slide or width} seconds")


def rate_stream(log: DataFrame, keys=(), width: int = 300, slide: int | None = None,
                late: str = "10 minutes") -> DataFrame:
    """Request rate per closed window."""
    counted = watermarked(log, late).groupBy(_window(width, slide).alias("w"), *keys).agg(
        F.count(F.lit(1)).alias("n"))
    return counted.select(*keys, F.col("w.start").alias("window_start"),
                          (F.col("n") / F.lit(float(width))).alias("rate"))


def error_ratio_stream(log: DataFrame, keys=(), width: int = 300, late: str = "10 minutes") -> DataFrame:
    failed = F.when(fully_matches(F.col("status"), "5.."), F.lit(1))
    counted = watermarked(log, late).groupBy(_window(width, None).alias("w"), *keys).agg(
        F.count(failed).alias("errors"), F.count(F.lit(1)).alias("n"))
    return counted.select(*keys, F.col("w.start").alias("window_start"),
                          (F.col("errors") / F.col("n")).alias("value"))


def histogram_stream(log: DataFrame, keys=(), width: int = 300, late: str = "10 minutes",
                     bounds=LATENCY_BOUNDS) -> DataFrame:
    """Cumulative bucket counts per closed window, for quantiles downstream."""
    counted = watermarked(log, late).groupBy(_window(width, None).alias("w"), *keys).agg(
        *cumulative_counts(F.col("duration"), bounds))
    return counted.withColumn("window_start", F.col("w.start")).drop("w")


def latency_stream(log: DataFrame, keys=(), width: int = 300, late: str = "10 minutes",
                   phi: float = 0.95, bounds=LATENCY_BOUNDS) -> DataFrame:
    """One interpolated quantile per closed window, as ``value``."""
    counts = [F.col(c) for c in bucket_columns(bounds)]
    return histogram_stream(log, keys, width, late, bounds).select(
        *keys, "window_start", quantile(phi, bounds, counts).alias("value"))


def append_stream(df: DataFrame, path: str, checkpoint: str, trigger=None):
    """Closed windows or plain rows into a Parquet table, exactly once."""
    return (df.writeStream.outputMode("append").format("parquet").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or CAUGHT_UP)).start())


def scoring_stream(requests: DataFrame, model_path: str, log_path: str, checkpoint: str,
                   fill_values=None, version: str = MODEL_VERSION, trigger=None,
                   partitions: int | None = None):
    """Scores a stream of requests into the prediction log; ``partitions`` as in ``score_with``."""
    scored = score_with(models.load(model_path), requests, fill_values, partitions)
    rows = log_rows(prediction_rows(scored, version=version))
    return append_stream(rows, log_path, checkpoint, trigger)


def published_scoring_stream(requests: DataFrame, root: str, log_path: str, checkpoint: str,
                             fill_values=None, trigger=None, partitions: int | None = None):
    """``scoring_stream`` that looks for the current version before each micro-batch.

    A micro-batch is scored by one version, and its rows carry it; a repeated
    one replaces its rows, by the version that is current then. One that has
    ``partitions`` already is not shuffled.
    """
    current = CurrentModel(requests.sparkSession, root)
    # A micro-batch is given to ``write`` row by row, so the scan reads what the log keeps and no more.
    requests = requests.select(*[c for c in requests.columns if c in ("athlete_id", "prediction_date", *SERVING_DEFAULTS)])

    def write(batch: DataFrame, batch_id: int) -> None:
        version, model = current.get()
        few = partitions is not None and batch.rdd.getNumPartitions() < partitions
        rows = prediction_rows(score_with(model, batch, fill_values, partitions if few else None), version=version)
        log_rows(rows).write.mode("overwrite").parquet(batch_path(log_path, batch_id))

    return (requests.writeStream.foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or CAUGHT_UP)).start())


def alert_stream(values: DataFrame, rule: AlertRule, path: str, state_path: str, checkpoint: str,
                 keys=(), ts: str = "window_start", value: str = "value",
                 max_gap: int | None = None, trigger=None, slice_seconds: int | None = None):
    """Rule states of closed windows or raw samples, held across micro-batches.

    Micro-batches must follow each other in time, as closed windows do: one
    that starts before the state it finds fails, since its states would be
    wrong. Give ``slice_seconds`` for raw samples, of which a backlog has many.

    The state is one row per series. Each batch reads the state its
    predecessor wrote and writes its own to another of three slots, so it can
    be repeated and old states do not pile up.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        carried = carried_state(spark, state_path, batch_id)
        if carried is not None:
            _require_order(batch.withColumn("alert", F.lit(rule.name)), carried, ["alert", *keys], ts)
        held = evaluate(batch, rule, keys, ts, value, max_gap, slice_seconds, carried)
        held = held.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            held.write.mode("overwrite").parquet(batch_path(path, batch_id))
            state = closing_state(held, ["alert", *keys], ts)
            if carried is not None:
                seen = state.select("alert", *keys)
                quiet = carried.join(seen, ["alert", *keys], "left_anti")
                state = state.unionByName(quiet)
            state = state.withColumn("batch", F.lit(batch_id))
            state.write.mode("overwrite").parquet(slot_path(state_path, batch_id))
        finally:
            held.unpersist()

    return (values.writeStream.outputMode("append").foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or CAUGHT_UP)).start())


def _require_order(batch: DataFrame, carried: DataFrame, keys, ts: str) -> None:
    """Fails if a series goes on before the last sample of the batch before."""
    first = batch.withColumns({k: F.coalesce(k, F.lit("")) for k in keys}).groupBy(*keys).agg(F.min(ts).alias("first_ts"))
    late = first.join(carried.select(*keys, "last_ts"), list(keys)).filter(F.col("first_ts") < F.col("last_ts")).take(1)
    if late:
        raise ValidationError(f"samples at {late[0]['first_ts']} arrived after {late[0]['last_ts']}")


def slot_path(path: str, batch_id: int) -> str:
    return f"{path}/slot={batch_id % 3}"


def carried_state(spark: SparkSession, state_path: str, batch_id: int) -> DataFrame | None:
    """State written by the batch before this one; the first has none.

    Every batch writes its state, so a missing slot is an error, not a start.
    """
    if batch_id == 0:
        return None
    stored = spark.read.parquet(slot_path(state_path, batch_id - 1))
    return stored.filter(F.col("batch") == batch_id - 1).drop("batch")
