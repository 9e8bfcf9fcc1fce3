"""Plans that must keep their shape to hold on large tables."""

import pytest
from comparison import plan
from pyspark.sql import functions as F

from pacewell.operators import analytics, clean, dataset, features
from pacewell.session import shared_root, size_shuffles
from pacewell.sources import tables


@pytest.fixture(scope="module")
def stored(spark, golden, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "performance")
    tables.append_performance(golden, path)
    return tables.load_performance(spark, path)


def test_missing_values_are_filtered_in_the_scan(stored):
    text = plan(analytics.daily_means(clean.clean(stored)))
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    assert "PushedFilters: [IsNotNull(" in scan
    assert "athlete_id" not in scan.split("ReadSchema")[1]


def test_features_and_split_do_not_shuffle(stored):
    values = {"resting_heart_rate": 57.0, "hrv": 56.0}
    rows = dataset.hash_split(dataset.labelled(features.engineer(clean.clean(stored), values)))
    assert "Exchange" not in plan(rows) and "Join" not in plan(rows)


def test_listings_keep_the_top_only(stored):
    assert "TakeOrderedAndProject" in plan(analytics.latest_history(stored, 10))


def test_listings_read_the_newest_days_only(stored):
    scan = next(line for line in plan(analytics.latest_history(stored, 4)).splitlines() if "FileScan" in line)
    assert "GreaterThanOrEqual(record_date,2031-03-17)" in scan


def test_listings_look_into_a_hot_day(spark):
    """All rows of one day: what is sorted is little more than what is listed, ties at the cut included."""
    rows = spark.range(5000).selectExpr(
        "id", "timestamp_seconds(1893456000 + (id * 7919) % 5000 div 3) AS created_at", "id % 7 AS v").repartition(8)
    found = analytics.latest(rows, 20, "created_at", "id")
    wanted = sorted(rows.collect(), key=lambda r: (r["created_at"], r["id"]), reverse=True)[:20]
    assert [r["id"] for r in found.collect()] == [r["id"] for r in wanted]
    assert rows.filter(F.col("created_at") >= analytics._since(rows, 20, "created_at")).count() <= 20 + 3
    late = spark.createDataFrame([(9000 + i,) for i in range(8)], "id long").selectExpr("id", "timestamp_seconds(1893456000 + 90000) AS created_at", "id AS v")
    both = rows.unionByName(late)
    assert both.filter(F.col("created_at") >= analytics._since(both, 20, "created_at")).count() <= 20 + 3
    assert [r["id"] for r in analytics.latest(both, 20, "created_at", "id").collect()] == [9007 - i for i in range(8)] + [r["id"] for r in wanted[:12]]


def test_figures_do_not_sort_the_table(spark, stored):
    figures = analytics.prediction_figures(stored.select(
        "athlete_id", "performance_score", F.col("record_date").alias("created_at"), F.col("hrv").alias("id")))
    text = plan(figures)
    assert "SortAggregate" not in text and "Sort [" not in text


def test_selected_athletes_are_filtered_in_the_scan(stored):
    ids = [r[0] for r in analytics.athlete_ids(stored, 2).collect()]
    text = plan(analytics.for_athletes(stored, ids))
    assert text.count("FileScan") == 1 and "PushedFilters: [In(athlete_id" in text


def test_daily_means_combine_before_the_shuffle(stored):
    text = plan(analytics.daily_means(stored))
    assert text.index("functions=[avg(") < text.index("hashpartitioning") < text.index("partial_avg")


def test_exact_split_is_a_projection(spark):
    df = spark.range(100).withColumn("v", F.col("id") * 2)
    assert "Exchange" not in plan(dataset.exact_split(df, ["id"]))


def test_shuffles_grow_with_the_input(spark):
    session = spark.newSession()
    assert size_shuffles(session, 100 << 40) == 819200
    assert session.conf.get("spark.sql.shuffle.partitions") == "819200"
    assert size_shuffles(session, 1) == spark.sparkContext.defaultParallelism


def test_scratch_is_below_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or shared_root(spark) == named.rstrip("/")
