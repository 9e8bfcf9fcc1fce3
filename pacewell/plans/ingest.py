"""Intake: files or frames to the performance table."""

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pacewell.operators.intake import coerce, require_valid, split_valid
from pacewell.sources import files
from pacewell.sources.tables import append_performance


def ingest_frame(records: DataFrame, table_path: str, by_month: bool = False) -> int:
    """Coerces and appends; no range checks, as for CSV. Returns the row count."""
    return append_performance(coerce(records), table_path, by_month)


def ingest_csv(spark: SparkSession, path: str, table_path: str,
               max_rows_per_file: int | None = None, by_month: bool = False) -> int:
    return append_performance(
        files.read_csv(spark, path, max_rows_per_file=max_rows_per_file), table_path, by_month)


def ingest_json(spark: SparkSession, path: str, table_path: str, profile: str = "ingest",
                max_records: int | None = None, by_month: bool = False) -> int:
    """Range-checked batches: one bad record or document rejects all of them.

    ``ingest_or_quarantine`` of a lenient read keeps the good ones instead.
    """
    records = files.read_json_batches(spark, path, max_records)
    return append_performance(require_valid(records, profile), table_path, by_month)


def ingest_or_quarantine(records: DataFrame, table_path: str, quarantine_path: str,
                         profile: str = "ingest", by_month: bool = False) -> tuple[int, int]:
    """Appends the good rows and sets the bad ones aside with their violations."""
    good, bad = split_valid(coerce(records, strict=False), profile)
    kept = append_performance(good, table_path, by_month)
    seen = Observation()
    bad.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(quarantine_path)
    return kept, seen.get["n"]
