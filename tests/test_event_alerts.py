"""Alert states in event time: shuffled micro-batches against the batch operator."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pacewell.operators import alerts
from pacewell.settings import SERVICE_DOWN
from pacewell.streaming import event_alerts, jobs

START = datetime(2031, 5, 4)
SCHEMA = "ts timestamp, job string, up int"
NAMES = ["job", "ts", "value", "since", "state", "severity", "summary"]


def samples():
    """Three series of samples every 15 to 75 seconds, down for a while now and then; ties and a null among them."""
    rng, rows = random.Random(3), []
    for job in ("api", "ml-trainer", None):
        at, down = START, 0
        for i in range(240):
            at += timedelta(seconds=rng.choice([15, 30, 75, 75]) if i != 120 else 3000)
            down = down - 1 if down > 0 else rng.choice([0] * 12 + [4, 9])
            rows.append((at, job, None if i == 50 else 0 if down else 1))
            if i % 31 == 0:
                rows.append((at, job, 1 - rows[-1][2] if rows[-1][2] is not None else 0))
    return rows


def arrivals(rows, late, files):
    """Rows in files by when they arrive: up to ``late`` seconds after they were taken, in random order."""
    rng = random.Random(11)
    due = sorted(rows, key=lambda r: r[0] + timedelta(seconds=rng.uniform(0, late)))
    size = len(due) // files + 1
    return [due[i : i + size] for i in range(0, len(due), size)]


def run_stream(spark, folder, parts, max_gap, late="12 minutes"):
    for i, part in enumerate(parts):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    states = event_alerts.event_time_alerts(source, SERVICE_DOWN, ["job"], late, value="up", max_gap=max_gap)
    stream = event_alerts.with_state_store(spark, lambda: jobs.append_stream(states, f"{folder}/out", f"{folder}/checkpoint"))
    stream.awaitTermination()
    return spark.read.schema(states.schema).parquet(f"{folder}/out"), stream


def as_rows(df):
    return sorted((tuple(map(str, r)) for r in df.select(*NAMES).collect()))


@pytest.mark.parametrize("max_gap", [None, 120])
def test_shuffled_batches_give_the_batch_result(spark, tmp_path, max_gap):
    rows = samples()
    end = max(r[0] for r in rows)
    # What comes last lets the watermark pass all that counts.
    flush = [(end + timedelta(hours=1), "flush", 1)], [(end + timedelta(hours=2), "flush", 1)]
    found, stream = run_stream(spark, tmp_path, [*arrivals(rows, 600, 6), *flush], max_gap)
    batch = spark.createDataFrame(rows, SCHEMA)
    expected = alerts.evaluate(batch, SERVICE_DOWN, ["job"], value="up", max_gap=max_gap)
    assert as_rows(found.filter("job <> 'flush'")) == as_rows(expected)
    assert {r["state"] for r in found.select("state").distinct().collect()} == {"inactive", "pending", "firing"}
    kept = stream.recentProgress[-1]["stateOperators"][0]["numRowsTotal"]
    assert kept <= (12 if max_gap else 30)  # samples that were passed are gone, with a gap also silent series


def test_samples_beyond_the_bound_are_left_out(spark, tmp_path):
    on_time = [[(START + timedelta(minutes=m), "api", 0)] for m in (0, 10, 40, 41)]  # the bound counts from the batch after
    too_late = [[(START + timedelta(minutes=5), "api", 1)], [(START + timedelta(minutes=90), "api", 1)]]
    found, _ = run_stream(spark, tmp_path, [*on_time, *too_late], None)
    states = {r["ts"]: (r["state"], r["since"]) for r in found.collect()}
    assert states[START + timedelta(minutes=40)] == ("firing", START)
    assert START + timedelta(minutes=5) not in states
