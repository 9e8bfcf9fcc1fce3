"""Daily partials: merged figures against the operators that read the records."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from pacewell.operators import analytics, rollup
from pacewell.operators.order_stats import exact_medians
from pacewell.schemas import LABEL, RECORD
from pacewell.streaming import rollups

DAY = date(2031, 5, 1)


@pytest.fixture(scope="module")
def records(spark):
    rng = random.Random(5)
    rows = []
    for i in range(9000):
        day = DAY + timedelta(days=rng.randrange(12)) if i % 500 else None
        values = [rng.uniform(1, 10) for _ in range(5)]
        sensors = [rng.gauss(60, 9) if i % 3 else None, rng.expovariate(0.02) if i % 7 else float("nan")]
        rows.append((f"a{int(rng.paretovariate(0.6)) % 3000}" if i % 900 else None, day, *values, *sensors, rng.uniform(0, 100) if i % 4 else None))
    rows.append(("lonely", DAY + timedelta(days=40), 1.0, 1.0, 1.0, 1.0, 1.0, None, None, None))
    return spark.createDataFrame(rows, RECORD)


def close(a, b):
    return [(r[0], pytest.approx(r[1], abs=1e-9)) for r in a] == [tuple(r) for r in b]


def check(partials, records):
    exact = analytics.history_figures(records).first()
    found = rollup.history_figures(partials).first()
    assert (found["records"], found["first_date"], found["last_date"]) == (exact["records"], exact["first_date"], exact["last_date"])
    assert abs(found["athletes"] - exact["athletes"]) <= rollup.DISTINCT_ERROR * exact["athletes"]
    means = analytics.daily_means(records).filter("record_date IS NOT NULL").collect()
    assert close(rollup.daily_means(partials).filter("record_date IS NOT NULL").collect(), means) and len(means) == 12
    for c in ("resting_heart_rate", "hrv", LABEL):
        values = sorted(r[0] for r in records.filter(F.col(c).isNotNull() & ~F.isnan(c)).select(c).collect())
        got = rollup.quantiles(partials, c, {"low": 0.05, "median": 0.5, "high": 0.95}).first()
        for name, phi in (("low", 0.05), ("median", 0.5), ("high", 0.95)):
            rank = sum(v < got[name] for v in values) / len(values)
            assert abs(rank - phi) <= rollup.RANK_ERROR + 1 / len(values)
    medians = exact_medians(records, {"hrv": (0.0, 200.0)})
    rank = records.filter(F.col("hrv") < medians["hrv"]).count() / records.filter("NOT isnan(hrv)").count()
    assert abs(rank - 0.5) < 0.01


def test_partials_of_a_batch(records):
    check(rollup.daily_partials(records), records)


def test_partials_merge_in_any_way(records):
    parts = [rollup.daily_partials(records.filter(F.abs(F.hash("sleep_hours")) % 5 == i)) for i in range(5)]
    some = rollup.merge_partials(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    every = some.unionByName(parts[3]).unionByName(parts[4])
    check(every, records)
    check(rollup.merge_partials(every), records)
    assert rollup.merge_partials(every).count() == 14


def test_figures_by_group_and_of_nothing(spark, records):
    partials = rollup.daily_partials(records).withColumn("odd", F.day("record_date") % 2)
    by_group = {r["odd"]: r["records"] for r in rollup.history_figures(partials, "odd").collect()}
    assert sum(by_group.values()) == records.count()
    nothing = rollup.daily_partials(records.limit(0))
    assert tuple(rollup.history_figures(nothing).first()) == (0, 0, None, None)
    lonely = rollup.daily_partials(records.filter("athlete_id = 'lonely'"))
    assert rollup.quantiles(lonely, "hrv", {"median": 0.5}).first()["median"] is None
    assert rollup.history_figures(lonely).first()["athletes"] == 1
    assert rollup.daily_means(lonely).count() == 0
    with pytest.raises(ValueError):
        rollup.quantiles(lonely, "sleep_hours", {"median": 0.5})


def test_stream_counts_a_repeated_batch_once(spark, records, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    for i in range(3):
        records.filter(F.abs(F.hash("sleep_hours")) % 3 == i).coalesce(1).write.mode("append").parquet(source)
    arriving = spark.readStream.schema(records.schema).option("maxFilesPerTrigger", 1).parquet(source)
    rollups.rollup_stream(arriving, out, checkpoint).awaitTermination()
    # The last batch was written, but the stream died before it said so.
    last = max((tmp_path / "checkpoint" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last.unlink()
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    rollups.rollup_stream(arriving, out, checkpoint).awaitTermination()
    partials = rollups.read_rollup(spark, out)
    check(partials, records)
    assert partials.count() > 14
    assert rollups.condensed(spark, out, str(tmp_path / "condensed")).count() == 14
    check(spark.read.parquet(str(tmp_path / "condensed")), records)
