import math
import random
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pacewell.operators import order_stats
from pacewell.operators.dataset import exact_split


def frame(spark, values, kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.floats(0, 200, allow_nan=False, width=32)), min_size=1, max_size=60))
def test_median_equals_sorting(spark, values):
    known = [v for v in values if v is not None]
    got = order_stats.exact_medians(frame(spark, values), {"x": (0.0, 200.0)})["x"]
    assert got == (pytest.approx(statistics.median(known), abs=1e-12) if known else None)


def test_many_passes(spark, monkeypatch):
    monkeypatch.setattr(order_stats, "BUCKETS", 2)
    rng = random.Random(1)
    values = [200 * 0.5 ** rng.uniform(0, 40) for _ in range(301)] + [1e-9] * 100
    assert order_stats.exact_medians(frame(spark, values), {"x": (0.0, 200.0)})["x"] == statistics.median(values)


def test_values_outside_the_bounds_count(spark):
    values = [-50.0, -3.0, -2.0, 5.0, 300.0, 1e6, 1e7, float("nan"), None]
    got = order_stats.exact_medians(frame(spark, values), {"x": (0.0, 200.0)})["x"]
    assert got == 5.0
    low = order_stats.exact_medians(frame(spark, [-9.0, -8.0, -7.0, 1.0]), {"x": (0.0, 200.0)})["x"]
    assert low == -7.5


def test_ranks_with_one_hot_value(spark):
    values = [7] * 500 + list(range(1000, 2000))
    random.Random(2).shuffle(values)
    ordered = sorted(values)
    ranks = [0, 499, 500, 749, 1499]
    got = order_stats.select_ranks(frame(spark, values, "long"),
                                   {"x": (F.col("x"), "long", 0, 2**60)}, lambda n: ranks)["x"]
    assert [g.value for g in got] == [ordered[r] for r in ranks]
    assert (got[0].below, got[0].equal) == (0, 500)
    for g in got:
        assert g.below == sum(v < g.value for v in values)


def test_long_values_beyond_double_precision(spark):
    base = 2**59
    values = [base + i for i in range(50)]
    got = order_stats.select_ranks(frame(spark, values, "long"),
                                   {"x": (F.col("x"), "long", 0, 2**60)}, lambda n: [17])["x"][0]
    assert got.value == base + 17 and got.below == 17 and got.equal == 1


def sizes(split):
    return {r["split"]: r["n"] for r in split.groupBy("split").agg(F.count("*").alias("n")).collect()}


@pytest.mark.parametrize("n", [1, 10, 333])
def test_exact_split_size(spark, n):
    got = sizes(exact_split(spark.range(n).withColumn("v", F.col("id") * 2), ["id"]))
    assert got.get("test", 0) == math.ceil(0.2 * n) and sum(got.values()) == n


def test_exact_split_of_copies(spark):
    """One row holds most of the table; the cut goes through its copies."""
    df = spark.range(300).select(
        F.when(F.col("id") < 280, F.lit(5)).otherwise(F.col("id")).alias("k"),
        F.when(F.col("id") < 280, F.lit(1.5)).otherwise(F.lit(2.5)).alias("v"))
    split = exact_split(df, ["k"])
    assert sizes(split) == {"test": 60, "train": 240}
    assert split.drop("split").exceptAll(df).isEmpty() and df.exceptAll(split.drop("split")).isEmpty()


def test_exact_split_of_one_key_with_different_rows(spark):
    df = spark.range(200).select(F.lit(1).alias("k"), F.col("id"))
    split = exact_split(df, ["k"])
    assert sizes(split) == {"test": 40, "train": 160}
    again = exact_split(df.repartition(5, "id"), ["k"])
    assert split.exceptAll(again).isEmpty()


def test_exact_split_of_nothing(spark):
    assert exact_split(spark.range(0), ["id"]).isEmpty()


def test_infinities_and_wide_spans_end(spark):
    inf = float("inf")
    for values in ([-inf, -5.0, -4.0, 1.0, 2.0], [inf, inf, 3.0], [-1e308, -1.0, 0.5, 1e308], [-inf, inf], [-inf, -1e308, 7.0, 1e308, inf]):
        df = spark.createDataFrame([(v,) for v in values], "x double")
        for rank, wanted in enumerate(sorted(values)):
            found = order_stats.select_ranks(df, {"x": (F.col("x"), "double", 0.0, 10.0)}, lambda n, r=rank: [r])["x"]
            assert found[0].value == wanted and found[0].total == len(values)
