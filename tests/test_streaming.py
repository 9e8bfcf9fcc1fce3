"""Streams cut into several micro-batches give what the batch operators give."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pacewell.operators import alerts, intake
from pacewell.operators import observability as obs
from pacewell.schemas import RECORD_COLUMNS, REQUEST_LOG
from pacewell.settings import HIGH_ERROR_RATE, SERVICE_DOWN
from pacewell.sources import files
from pacewell.streaming import jobs

START = datetime(2031, 5, 4)


def write_lines(path, name, rows):
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join([",".join(RECORD_COLUMNS), *rows]) + "\n")


def run(query):
    query.awaitTermination()


def test_intake_splits_files_as_the_batch_does(spark, tmp_path):
    source = tmp_path / "in"
    write_lines(source, "a.csv", ["a1,2031-05-04,6.25,3,512.5,2,7,71,38.5,47", "a2,never,6,3,512,2,7,,,"])
    write_lines(source, "b.csv", ["a3,2031-05-05,6.25,30,512.5,2,7,71,38.5,47", "a4,2031-05-05,6,3,1,2,7,,,"])
    paths = [str(tmp_path / p) for p in ("good", "bad", "checkpoint")]

    def catch_up():
        run(jobs.intake_stream(jobs.csv_stream(spark, str(source), max_files=1), *paths))
        good = [r["athlete_id"] for r in spark.read.parquet(paths[0]).collect()]
        bad = {r["athlete_id"]: r["violations"] for r in spark.read.parquet(paths[1]).collect()}
        return sorted(good), bad

    good, bad = catch_up()
    assert good == ["a1", "a4"]
    assert bad == {"a2": ["record_date_unparsed", "record_date_missing"], "a3": ["sleep_quality_range"]}
    batch_good, _ = intake.split_valid(files.read_csv(spark, str(source), strict=False))
    assert sorted(r["athlete_id"] for r in batch_good.collect()) == good
    # A later file is picked up by the next run, the earlier ones are not read again.
    write_lines(source, "c.csv", ["a5,2031-05-06,6.25,3,512.5,2,7,71,38.5,47", "a6,2031"])
    good, bad = catch_up()
    assert good == ["a1", "a4", "a5"] and "damaged_line" in bad["a6"]


@pytest.fixture(scope="module")
def log(spark):
    rows = []
    for i in range(2000):
        t = START + timedelta(seconds=11 * i)
        failing = 300 <= i < 900 and i % 4 == 0
        rows.append((i, t, "api", "GET", "/predict", "500" if failing else "200", (i % 40) / 10))
    return spark.createDataFrame(rows, REQUEST_LOG)


def stream_of(spark, log, path, parts):
    """The log as files that arrive in time order, one per micro-batch."""
    for i in range(parts):
        step = 2000 // parts
        part = log.filter(F.col("event_id").between(i * step, (i + 1) * step - 1))
        part.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(REQUEST_LOG).option("maxFilesPerTrigger", 1).parquet(path)


def closed(df, log):
    end = log.agg(F.max("ts")).first()[0] - timedelta(minutes=10)
    return df.filter(F.col("window_start") + F.expr("INTERVAL 5 MINUTES") <= F.lit(end))


def rows_of(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_rates(spark, log, tmp_path):
    stream = stream_of(spark, log, str(tmp_path / "in"), 4)
    rates = jobs.rate_stream(stream, ["endpoint"])
    run(jobs.append_stream(rates, str(tmp_path / "out"), str(tmp_path / "c")))
    names = ["endpoint", "window_start", "rate"]
    got = rows_of(spark.read.parquet(str(tmp_path / "out")), *names)
    assert got and got == rows_of(closed(obs.request_rate(log, ["endpoint"]), log), *names)


def test_histogram(spark, log, tmp_path):
    stream = stream_of(spark, log, str(tmp_path / "in"), 2)
    run(jobs.append_stream(jobs.histogram_stream(stream), str(tmp_path / "out"), str(tmp_path / "c")))
    names = ["window_start", "le_0", "le_9", "le_inf"]
    expected = closed(obs.latency_histogram(log, [], 300), log)
    assert rows_of(spark.read.parquet(str(tmp_path / "out")), *names) == rows_of(expected, *names)


def test_alert_held_across_batches(spark, log, tmp_path):
    stream = stream_of(spark, log, str(tmp_path / "in"), 8)
    out = str(tmp_path / "out")
    run(jobs.alert_stream(jobs.error_ratio_stream(stream), HIGH_ERROR_RATE, out,
                          str(tmp_path / "state"), str(tmp_path / "c"), max_gap=300))
    names = ["window_start", "state", "severity"]
    got = spark.read.parquet(out)
    assert got.select("batch_id").distinct().count() > 2
    expected = closed(alerts.high_error_rate(log), log)
    assert rows_of(got, *names) == rows_of(expected, *names)
    assert got.filter("state = 'firing'").count() > 5


def up_files(spark, path, order):
    """Raw samples of one job, down from minute 5 on, as files of ten minutes that arrive in the given order."""
    for part in order:
        rows = [(START + timedelta(minutes=m), "api", 0 if m >= 5 else 1) for m in range(10 * part, 10 * part + 10)]
        spark.createDataFrame(rows, "ts timestamp, job string, up int").coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema("ts timestamp, job string, up int").option("maxFilesPerTrigger", 1).parquet(path)


def down_states(spark, stream, tmp_path, **more):
    paths = [str(tmp_path / p) for p in ("out", "state", "c")]
    run(jobs.alert_stream(stream, SERVICE_DOWN, *paths, keys=["job"], ts="ts", value="up", **more))
    return rows_of(spark.read.parquet(paths[0]), "ts", "since", "state")


@pytest.mark.parametrize("slices", [None, 120])
def test_raw_samples_over_batches_equal_the_batch(spark, tmp_path, slices):
    stream = up_files(spark, str(tmp_path / "in"), range(4))
    whole = alerts.service_down(spark.read.parquet(str(tmp_path / "in")))
    assert down_states(spark, stream, tmp_path, slice_seconds=slices) == rows_of(whole, "ts", "since", "state")


def test_samples_out_of_order_fail(spark, tmp_path):
    stream = up_files(spark, str(tmp_path / "in"), [1, 0])
    with pytest.raises(Exception, match="arrived after"):
        down_states(spark, stream, tmp_path)


def test_json_stream_keeps_damaged_documents(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    good = '{"records":[{"athlete_id":"a1","record_date":"2031-05-04","sleep_hours":6,"sleep_quality":3,"training_load":512,"stress_level":2,"recovery_score":7}]}'
    (source / "a.json").write_text(good + '\n{"records":[{"athlete_id"\n{"records":[]}\n' + good.replace("512", '"heavy"').replace("a1", "a2") + "\n")
    run(jobs.intake_stream(jobs.json_stream(spark, str(source)), *[str(tmp_path / p) for p in ("good", "bad", "c")]))
    assert [r["athlete_id"] for r in spark.read.parquet(str(tmp_path / "good")).collect()] == ["a1"]
    bad = {r["athlete_id"]: r["violations"][0] for r in spark.read.parquet(str(tmp_path / "bad")).collect()}
    assert bad == {None: "damaged_line", "a2": "training_load_unparsed"}
