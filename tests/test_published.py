"""Model versions: readers find a whole one, whatever is being written."""

import threading

import pytest
from pyspark.sql import functions as F

from pacewell.errors import ModelNotReadyError, ValidationError
from pacewell.plans import model as models
from pacewell.plans import published, scoring, training
from pacewell.plans.model import ForestSettings
from pacewell.sources import tables
from pacewell.sources.testviews import perf_raw
from pacewell.streaming import jobs

SETTINGS = training.TrainingSettings(key_columns=("record_key",))


@pytest.fixture(scope="module")
def records(spark):
    return perf_raw(spark, "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def fitted(records):
    """Two models that differ in every score."""
    train = training.prepare(records, SETTINGS).filter("split = 'train'")
    return [models.fit(train, ForestSettings(trees=t, depth=3)) for t in (1, 2)]


@pytest.fixture(scope="module")
def requests(records):
    return records.withColumn("prediction_date", F.col("record_date"))


def scores(model, requests):
    return sorted(r[0] for r in models.score(model, scoring.features_for(requests)).select("prediction").collect())


def test_versions_in_turn(spark, fitted, requests, tmp_path):
    root = str(tmp_path)
    with pytest.raises(ModelNotReadyError):
        published.current_version(spark, root)
    current = published.CurrentModel(spark, root)
    for name, model in zip(("a", "b"), fitted):
        assert published.publish(model, root, name) == name
        assert current.get()[0] == published.current_version(spark, root) == name
        assert scores(current.get()[1], requests) == scores(model, requests)
    published.go_back(spark, root, "a")
    assert current.get()[0] == "a" and published.publications(spark, root).count() == 3
    with pytest.raises(ModelNotReadyError):
        published.go_back(spark, root, "never")
    with pytest.raises(Exception):
        published.publish(fitted[0], root, "a")  # a version is not overwritten
    with pytest.raises(ValidationError):
        published.publish(fitted[0], root, "../a")
    assert published.current_version(spark, root) == "a"


def test_half_a_model_is_never_current(spark, fitted, tmp_path):
    root = str(tmp_path)
    published.publish(fitted[0], root, "whole")
    # What a writer leaves that is at work, or that died: a folder without a publication.
    half = tmp_path / "versions" / "half" / "metadata"
    half.mkdir(parents=True)
    (half / "part-00000").write_text("{")
    assert published.CurrentModel(spark, root).get()[0] == "whole"
    with pytest.raises(ModelNotReadyError):
        published.go_back(spark, root, "half")


def test_two_publishers_at_once(spark, fitted, tmp_path):
    root = str(tmp_path)
    for name in ("x", "y"):
        fitted[0].write().save(published.version_path(root, name))
    rows = spark.createDataFrame([(1, "y"), (1, "x")], "number long, version string")
    rows.withColumn("published_at", F.current_timestamp()).write.parquet(f"{root}/published")
    assert published.current_version(spark, root) == "y"
    published.publish(fitted[1], root, "z")
    assert published.current_version(spark, root) == "z"


def test_scoring_while_versions_are_saved(spark, fitted, requests, tmp_path):
    root = str(tmp_path)
    published.publish(fitted[0], root, "v0")
    wanted = [scores(m, requests) for m in fitted]
    failures = []

    def publish_often():
        try:
            for i in range(1, 4):
                published.publish(fitted[i % 2], root, f"v{i}")
        except Exception as error:  # shown by the test
            failures.append(error)

    writer = threading.Thread(target=publish_often)
    writer.start()
    seen = set()
    while writer.is_alive() or not seen:
        log = f"{root}/log{len(seen)}-{id(object())}"
        scoring.score_published(requests, root, log)
        rows = tables.load_predictions(spark, log).select("model_version", "performance_score").collect()
        (version,) = {r["model_version"] for r in rows}
        assert sorted(r["performance_score"] for r in rows) == wanted[int(version[1]) % 2]
        seen.add(version)
    writer.join()
    assert not failures and published.current_version(spark, root) == "v3"


def test_a_stream_looks_before_each_batch(spark, fitted, requests, tmp_path):
    root, log, checkpoint = (str(tmp_path / n) for n in ("models", "log", "checkpoint"))
    for i, model in enumerate(fitted):
        published.publish(model, root, f"v{i}")
        requests.write.mode("append").parquet(str(tmp_path / "in"))
        arriving = spark.readStream.schema(requests.schema).parquet(str(tmp_path / "in"))
        jobs.published_scoring_stream(arriving, root, log, checkpoint).awaitTermination()
    rows = tables.load_predictions(spark, log).select("model_version", "performance_score").collect()
    for i, model in enumerate(fitted):
        assert sorted(r["performance_score"] for r in rows if r["model_version"] == f"v{i}") == scores(model, requests)


def test_a_stream_reads_what_it_logs_and_deals_few_partitions_only(spark, fitted, requests, tmp_path, monkeypatch):
    root, seen, score_with = str(tmp_path / "models"), [], jobs.score_with

    def watched(model, batch, fill_values, partitions):
        seen.append((set(batch.columns), partitions))
        return score_with(model, batch, fill_values, partitions)

    monkeypatch.setattr(jobs, "score_with", watched)
    published.publish(fitted[0], root, "v")
    requests.repartition(3).write.option("maxRecordsPerFile", 1000).parquet(str(tmp_path / "in"))
    for partitions in (1, 40):
        arriving = spark.readStream.schema(requests.schema).parquet(str(tmp_path / "in"))
        log, checkpoint = (str(tmp_path / f"{n}{partitions}") for n in ("log", "checkpoint"))
        jobs.published_scoring_stream(arriving, root, log, checkpoint, partitions=partitions).awaitTermination()
        rows = tables.load_predictions(spark, log).select("performance_score").collect()
        assert sorted(r[0] for r in rows) == scores(fitted[0], requests)
    assert [p for _, p in seen] == [None, 40]
    assert all(not columns & {"record_key", "record_date", "performance_score"} for columns, _ in seen)


def test_training_publishes_what_it_logs(spark, records, tmp_path):
    root, runs = str(tmp_path / "models"), str(tmp_path / "runs")
    small = training.TrainingSettings(key_columns=("record_key",), forest=ForestSettings(trees=2, depth=3))
    result = training.train_and_publish(spark, records, root, runs, small).first()
    run = tables.load_training_runs(spark, runs).first()
    assert result["model_version"] == run["model_version"] == published.current_version(spark, root)
    assert result["status"] == "completed" and run["metrics"] == result["metrics"]
