from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from pacewell.functions.histogram import bucket_columns, quantile
from pacewell.operators import analytics
from pacewell.operators import observability as obs
from pacewell.operators.timeline import counter_increase
from pacewell.plans import dashboard

START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def log(spark):
    rows = []
    for i in range(200):
        rows.append((i, START + timedelta(seconds=37 * i), "api" if i % 3 else "ml-trainer", "GET",
                     "/predict" if i % 5 else "/metrics/x", "503" if i % 7 == 0 else "200", i / 25.0))
    return spark.createDataFrame(
        rows, "event_id long, ts timestamp, job string, method string, endpoint string, status string, duration double")


def interpolate(spark, phi, bounds, counts):
    df = spark.createDataFrame([tuple(counts)], bucket_columns(bounds))
    return df.select(quantile(phi, bounds, [F.col(c) for c in df.columns]).alias("q")).first()["q"]


def test_quantile_interpolates(spark):
    assert interpolate(spark, 0.5, (1.0, 2.0), (4, 10, 10)) == pytest.approx(1 + 1 / 6)
    assert interpolate(spark, 0.2, (1.0, 2.0), (4, 10, 10)) == pytest.approx(0.5)


def test_quantile_in_the_last_bucket(spark):
    assert interpolate(spark, 0.95, (1.0, 2.0), (4, 5, 10)) == 2.0


def test_quantile_of_nothing(spark):
    assert interpolate(spark, 0.5, (1.0, 2.0), (0, 0, 0)) is None


def test_quantile_skips_empty_buckets(spark):
    assert interpolate(spark, 0.5, (1.0, 2.0, 3.0), (0, 0, 10, 10)) == 2.5


def test_quantile_range():
    with pytest.raises(ValueError):
        quantile(0.0, (1.0,), [F.lit(1), F.lit(1)])


def test_quantiles_of_bucket_counters(spark, log):
    """Scraped bucket counters give what the requests behind them give."""
    bounds = (0.5, 1.0, 2.5, 5.0)
    rows = [r for r in log.orderBy("ts").collect()]
    counts, samples = {}, [("api", b, START - timedelta(seconds=1), 0) for b in ("0.5", "1.0", "2.5", "5.0", "+Inf")]
    for r in rows:
        for label, bound in zip(("0.5", "1.0", "2.5", "5.0", "+Inf"), (*bounds, float("inf"))):
            counts[label] = counts.get(label, 0) + (r["duration"] <= bound)
            samples.append(("api", label, r["ts"], counts[label]))
    scraped = spark.createDataFrame(samples, "job string, le string, ts timestamp, v long")
    increases = counter_increase(scraped, ["job", "le"], "ts", "v", 300)
    got = obs.quantiles_of_buckets(increases.filter(F.col("window_start") >= F.lit(START)), bounds=bounds)
    expected = obs.latency_quantiles(log, bounds=bounds)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


def test_probe_paths_do_not_count(log):
    assert obs.measured(log).filter("endpoint LIKE '/metrics%'").isEmpty()
    assert obs.measured(log).count() == 160


def test_pattern_covers_the_whole_value(log):
    assert obs.matching(log, patterns={"status": "5."}).isEmpty()
    assert obs.matching(log, patterns={"status": "5.."}).count() == 29
    assert obs.matching(log, patterns={"job": "ap|trainer"}).isEmpty()


def test_panes_equal_sliding_windows(log):
    direct = log.groupBy(F.window("ts", "300 seconds", "60 seconds").start.alias("window_start"), "job").agg(
        (F.count("*") / 300.0).alias("rate"))
    got = obs.request_rate(log, ["job"], 300, slide=60)
    a = sorted((r["job"], r["window_start"], r["rate"]) for r in direct.collect())
    b = sorted((r["job"], r["window_start"], r["rate"]) for r in got.collect())
    assert a == b
    with pytest.raises(ValueError):
        obs.request_rate(log, [], 300, slide=70)


def test_success_ratio_without_errors_is_one(log):
    fine = log.filter("status = '200'")
    assert {r["success_ratio"] for r in obs.success_ratio(fine).collect()} == {1.0}


def test_grid_covers_silence(spark, log):
    sparse = log.filter("event_id IN (0, 199)")
    up = obs.up_samples(sparse, 600, ["api", "ml-trainer"])
    hours = 37 * 199 // 600 + 1
    assert up.count() == 2 * hours
    assert up.filter("up = 1").count() == 2
    assert obs.services_up(up, "api|ml-trainer").first()["services_up"] == 1


def test_last_known_skips_null(spark):
    df = spark.sql("SELECT * FROM VALUES ('a', 1, 5D), ('a', 2, 6D), ('a', 3, NULL) AS t(k, ts, v)")
    assert obs.last_known(df, ["k"], "v", "ts").first()["v"] == 6.0


def test_page_limits(spark):
    df = spark.range(30).selectExpr("id", "timestamp_seconds(id * 7200) AS at")
    for n, ids in ((1, [29]), (13, list(range(29, 16, -1))), (30, list(range(29, -1, -1))), (99, list(range(29, -1, -1))), (None, list(range(29, -1, -1)))):
        assert [r["id"] for r in analytics.latest(df, n, "at", "id").collect()] == ids
    with pytest.raises(ValueError):
        analytics.latest(df, 0, "at")


def test_athlete_filter(golden):
    assert analytics.for_athletes(golden, []).count() == 15
    assert analytics.for_athletes(golden, ["runner_b"]).count() == 5
    ids = analytics.athlete_ids(golden, 2)
    assert analytics.for_athletes(golden, ids).count() == 10
    assert analytics.for_athletes(golden, ids.limit(0)).count() == 15


def test_melt_ignores_absent_columns(golden):
    long = analytics.melt(golden, ["athlete_id"], ["hrv", "nothing"])
    assert long.columns == ["athlete_id", "series", "value"] and long.count() == 15


def test_history_page(golden):
    page = dashboard.history_page(golden, limit=None, athletes=["runner_a"])
    assert page.figures.first()["records"] == 5
    assert [r["value"] for r in page.series.collect()] == [31.25 + n * 17 % 61 for n in range(5)]
    assert dashboard.history_page(golden, athletes=[]).figures.first()["records"] == 15
    newest = dashboard.history_page(golden, limit=3, athletes=[]).figures.first()
    assert newest["records"] == 3 and newest["first_date"] == newest["last_date"]


def test_predictions_page(spark):
    df = spark.sql("SELECT id, concat('a', id % 3) AS athlete_id, timestamp_seconds(id) AS created_at, "
                   "CAST(id AS DOUBLE) AS performance_score FROM range(10)")
    page = dashboard.predictions_page(df, limit=4)
    figures = page.figures.first()
    assert (figures["total_predictions"], figures["latest_score"], figures["unique_athletes"]) == (4, 9.0, 3)
    assert [r["value"] for r in page.series.collect()] == [6.0, 7.0, 8.0, 9.0]
    assert page.preview.first()["id"] == 9
