from datetime import date

import pytest
from pyspark.sql import functions as F

from pacewell.errors import ValidationError
from pacewell.operators.analytics import latest_predictions, latest_training_runs
from pacewell.schemas import PERFORMANCE, RECORD_COLUMNS
from pacewell.plans import ingest
from pacewell.sources import files, tables


def test_appends_keep_repeats(spark, golden, tmp_path):
    path = str(tmp_path / "t")
    assert tables.append_performance(golden, path) == 15
    assert tables.append_performance(golden, path) == 15
    stored = spark.read.parquet(path)
    assert stored.columns == PERFORMANCE.names and stored.count() == 30
    assert stored.select("id").distinct().count() == 30
    assert stored.filter("created_at IS NULL").isEmpty()


def test_month_layout_prunes(spark, golden, tmp_path):
    path = str(tmp_path / "t")
    moved = golden.withColumn("record_date", F.add_months("record_date", 2))
    tables.append_performance(golden.unionByName(moved), path, by_month=True)
    march = tables.load_performance(spark, path, since=date(2031, 5, 1))
    assert march.columns == RECORD_COLUMNS and march.count() == 15
    assert len(march.inputFiles()) >= 1
    plan = march._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(record_month" in plan
    assert tables.load_performance(spark, path, until=date(2031, 3, 13)).count() == 6


def test_logs_feed_the_listings(spark, golden, tmp_path):
    scored = golden.withColumns({"prediction": F.col("performance_score") / 3, "prediction_date": F.col("record_date")})
    assert tables.append_predictions(tables.prediction_rows(scored), str(tmp_path / "p")) == 15
    page = latest_predictions(tables.load_predictions(spark, str(tmp_path / "p")), 4).collect()
    assert len(page) == 4 and "T" in page[0]["created_at"]
    tables.append_training_run(spark, str(tmp_path / "r"), 12, {"test_mae": 1.5})
    run = latest_training_runs(tables.load_training_runs(spark, str(tmp_path / "r"))).first()
    assert (run["test_mae"], run["test_r2"], run["samples_used"], run["status"]) == (1.5, None, 12, "completed")


def test_ingest_jobs(spark, golden, golden_rows, tmp_path):
    table = str(tmp_path / "t")
    files.write_csv(golden, str(tmp_path / "csv"))
    files.write_json_batches(golden, str(tmp_path / "json"))
    assert ingest.ingest_csv(spark, str(tmp_path / "csv"), table) == 15
    assert ingest.ingest_json(spark, str(tmp_path / "json"), table) == 15
    assert ingest.ingest_frame(spark.createDataFrame(golden_rows, RECORD_COLUMNS), table) == 15
    assert tables.load_performance(spark, table).count() == 45
    odd = golden.withColumn("stress_level", F.when(F.col("hrv") > 66.5, 99.0).otherwise(F.col("stress_level")))
    files.write_json_batches(odd, str(tmp_path / "odd"))
    with pytest.raises(ValidationError, match="stress_level_range"):
        ingest.ingest_json(spark, str(tmp_path / "odd"), table)
    assert ingest.ingest_or_quarantine(odd, table, str(tmp_path / "q")) == (12, 3)
    assert tables.load_performance(spark, table).count() == 57
