"""A daily roll-up that follows the records, so that pages need not read the history."""

from pyspark.sql import DataFrame, SparkSession

from pacewell.operators.rollup import daily_partials, merge_partials
from pacewell.streaming.jobs import CAUGHT_UP, batch_path


def rollup_stream(records: DataFrame, path: str, checkpoint: str, trigger=None):
    """Writes the daily partials of each micro-batch.

    The folders by batch id are the ledger of what is in: a batch that is
    repeated after a failure replaces its own partials and counts once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        daily_partials(batch).write.mode("overwrite").parquet(batch_path(path, batch_id))

    return (records.writeStream.foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or CAUGHT_UP)).start())


def read_rollup(spark: SparkSession, path: str) -> DataFrame:
    """Partials of all batches, one row per day and batch."""
    return spark.read.parquet(path).drop("batch_id")


def condensed(spark: SparkSession, path: str, target: str) -> DataFrame:
    """One row per day of the batches so far, written elsewhere for readers; the ledger stays."""
    merge_partials(read_rollup(spark, path)).write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)
