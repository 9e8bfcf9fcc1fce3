"""Counter increases over a stream against the batch operator."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pacewell.operators.timeline import counter_increase
from pacewell.streaming import counters

START = datetime(2031, 5, 4)
SCHEMA = "ts timestamp, job string, n long, v long"


def samples():
    """Two busy series and one that is mostly silent, all with restarts."""
    rng, rows = random.Random(4), []
    for job, gap in (("api", 40), (None, 55), ("rare", 2500)):
        at, v = START, 5
        for n in range(300 if gap < 100 else 6):
            at += timedelta(seconds=rng.randint(0, gap))
            v = rng.randint(0, 3) if rng.random() < 0.05 else v + rng.randint(0, 9)
            rows.append((at, job, n, v))
    return rows


@pytest.mark.parametrize("files", [1, 5])
def test_stream_equals_batch_on_closed_windows(spark, tmp_path, files):
    rows, rng = samples(), random.Random(1)
    due = sorted(rows, key=lambda r: r[0] + timedelta(seconds=rng.uniform(0, 240)))
    size = len(due) // files + 1
    for i in range(0, len(due), size):
        spark.createDataFrame(due[i : i + size], SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    panes = counters.counter_panes(source, ["job"], "5 minutes", ties=["n"])
    names = [str(tmp_path / n) for n in ("out", "state", "checkpoint")]
    for _ in range(2):  # the second run finds nothing new and changes nothing
        counters.counter_increase_stream(panes, ["job"], 600, *names).awaitTermination()
    found = counters.read_counter_increase(spark, names[0], ["job"], 600)
    closed = F.col("window_start") + F.expr("INTERVAL 10 MINUTES") <= F.lit(max(r[0] for r in rows) - timedelta(minutes=5))
    batch = counter_increase(spark.createDataFrame(rows, SCHEMA), ["job"], "ts", "v", 600, ties=["n"]).filter(closed)
    columns = ["job", "window_start", "increase", "rate"]
    expected = sorted(tuple(r) for r in batch.select(*columns).collect())
    assert len(expected) > 20 and sorted(tuple(r) for r in found.filter(closed).select(*columns).collect()) == expected
    assert spark.read.parquet(names[0]).select("batch_id").distinct().count() >= files
