import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pacewell.operators import alerts
from pacewell.operators.timeline import closing_state, counter_increase, hold_state, running_number
from pacewell.settings import SERVICE_DOWN

START = datetime(2024, 1, 1)


def at(seconds):
    return START + timedelta(seconds=seconds)


def samples(spark, rows, names):
    kinds = {"ts": "timestamp", "v": "long", "x": "double", "up": "int", "job": "string", "id": "long"}
    return spark.createDataFrame(rows, ", ".join(f"{n} {kinds[n]}" for n in names))


def states(df):
    return [(r["ts"], r["since"], r["state"]) for r in df.orderBy("job", "ts").collect()]


def test_fires_exactly_at_the_hold(spark):
    rows = [("a", at(t), 0) for t in (0, 60, 119)] + [("a", at(120), 0), ("a", at(180), 1), ("a", at(240), 0)]
    got = alerts.service_down(
        samples(spark, [("api", t, u) for _, t, u in rows], ["job", "ts", "up"]), slice_seconds=None)
    assert [s for _, _, s in states(got)] == ["pending", "pending", "pending", "firing", "inactive", "pending"]
    first = got.orderBy("ts").first()
    assert first["summary"] == "api is down" and first["severity"] == SERVICE_DOWN.severity
    assert first["description"] == "Service api has been unreachable for 2 minutes."


def test_gap_breaks_the_hold(spark):
    df = samples(spark, [("a", at(t), 1.0) for t in (0, 60, 600, 660)], ["job", "ts", "x"])
    kept = hold_state(df, ["job"], "ts", F.col("x") > 0, 120)
    assert [s for *_, s in states(kept)] == ["pending", "pending", "firing", "firing"]
    cut = hold_state(df, ["job"], "ts", F.col("x") > 0, 120, max_gap=60)
    assert [s for *_, s in states(cut)] == ["pending"] * 4


def test_null_condition_is_false(spark):
    df = samples(spark, [("a", at(0), None)], ["job", "ts", "x"])
    assert states(hold_state(df, ["job"], "ts", F.col("x") > 0, 1)) == [(at(0), None, "inactive")]


@pytest.mark.parametrize("max_gap", [None, 90])
@pytest.mark.parametrize("width", [50, 300, 100000])
def test_slices_change_nothing(spark, width, max_gap):
    rng = random.Random(width)
    rows, t = [], 0
    for _ in range(400):
        t += rng.choice([10, 30, 60, 120, 400])
        # One series holds most of the rows.
        rows.append((rng.choice(["hot", "hot", "hot", "b", None]), at(t), float(rng.random() < 0.8)))
    df = samples(spark, rows, ["job", "ts", "x"])
    whole = hold_state(df, ["job"], "ts", F.col("x") > 0, 200, max_gap)
    sliced = hold_state(df, ["job"], "ts", F.col("x") > 0, 200, max_gap, slice_seconds=width)
    assert states(whole) == states(sliced)


def test_carried_state_equals_one_run(spark):
    rng = random.Random(4)
    rows = [(rng.choice("ab"), at(60 * i), float(rng.random() < 0.85)) for i in range(120)]
    df = samples(spark, rows, ["job", "ts", "x"])
    on = F.col("x") > 0
    whole = states(hold_state(df, ["job"], "ts", on, 180, max_gap=240))
    first, second = df.filter(F.col("ts") < at(3000)), df.filter(F.col("ts") >= at(3000))
    one = hold_state(first, ["job"], "ts", on, 180, max_gap=240)
    two = hold_state(second, ["job"], "ts", on, 180, max_gap=240,
                     carried=closing_state(one, ["job"], "ts"))
    assert whole == states(one.unionByName(two))


def test_counter_restart(spark):
    rows = [("a", at(0), 5), ("a", at(60), 8), ("a", at(120), 2), ("a", at(400), 6), ("b", at(10), 3)]
    got = counter_increase(samples(spark, rows, ["job", "ts", "v"]), ["job"], "ts", "v", 300)
    found = {(r["job"], r["window_start"]): (r["increase"], r["rate"]) for r in got.collect()}
    assert found == {("a", at(0)): (5, 5 / 300), ("a", at(300)): (4, 4 / 300), ("b", at(0)): (0, 0.0)}


@pytest.mark.parametrize("width", [60, 300])
def test_counter_slices_equal_one_window(spark, width):
    rng = random.Random(9)
    rows, v, t = [], 0, 0
    for _ in range(500):
        t += rng.choice([1, 15, 90, 700])
        v = v + rng.randrange(5) if rng.random() < 0.95 else rng.randrange(3)
        rows.append(("hot", at(t), v))
    df = samples(spark, rows, ["job", "ts", "v"])
    before = F.lag("v").over(Window.partitionBy("job").orderBy("ts", "v"))
    plain = df.withColumn("d", F.when(before.isNull(), 0).when(F.col("v") < before, F.col("v"))
                          .otherwise(F.col("v") - before))
    plain = plain.groupBy(F.window("ts", "300 seconds").start.alias("w")).agg(F.sum("d").alias("d"))
    got = counter_increase(df, ["job"], "ts", "v", 300, slice_seconds=width)
    assert sorted((r["w"], r["d"]) for r in plain.collect()) == sorted(
        (r["window_start"], r["increase"]) for r in got.collect())


def test_slice_must_divide_window(spark):
    with pytest.raises(ValueError):
        counter_increase(samples(spark, [], ["job", "ts", "v"]), ["job"], "ts", "v", 300, slice_seconds=70)


def test_running_number_equals_row_number(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["hot", "hot", "cold", None]), at(rng.randrange(9000)), i) for i in range(600)]
    df = samples(spark, rows, ["job", "ts", "id"])
    plain = df.withColumn("n", F.row_number().over(Window.partitionBy("job").orderBy("ts", "id")))
    got = running_number(df, ["job"], "ts", ["id"], slice_seconds=500)
    assert sorted((r["id"], r["n"]) for r in plain.collect()) == sorted((r["id"], r["n"]) for r in got.collect())
