"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the cores. Every query writes its
whole result to the no-op sink, so nothing is skipped and nothing collected.
"""

import json
import os
import sys
import time

from pacewell.plans.queries import QUERIES, fitted_model
from pacewell.session import local_session

HEADLINES = [
    "s01_csv_scan", "s03_json_scan", "s05_append_records", "s06_load_all", "s07_prediction_log",
    "v02_coercion", "v04_rules_ingest", "v04_row_violations", "v07_batch_policy",
    "c04_clean", "f01_median_fill", "f07_serving_features", "f08_feature_alignment",
    "d03_hash_split", "d04_exact_split", "d06_full_dataset",
    "m01_scaler_fit", "m02_scale", "m09_metric_rows", "m13_train_job", "m04_batch_predict",
    "m14_score_job", "m14_score_formula",
    "a01_latest_predictions", "a02_latest_training_runs", "a03_latest_history",
    "a04_prediction_figures", "a06_athlete_list", "a07_athlete_filter", "a08_history_figures",
    "a09_daily_means", "a09_daily_performance", "a11_melted_runs",
    "o02_request_rate", "o02_sliding_rate", "o03_latency_histogram", "o04_latency_quantiles",
    "o08_requests_per_minute", "o10_success_ratio", "o12_counter_increase",
    "o15_service_down", "o16_hold_state", "o17_high_latency", "o18_high_error_rate",
    "t01_intake_stream", "t02_rate_stream", "t03_scoring_stream", "t04_alert_stream",
]


SCORING = {"m03_forest_fit", "m04_batch_predict", "m14_score_job", "s10_model_store", "t03_scoring_stream"}


def run(query, spark, sf_dir) -> float:
    begun = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - begun


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = sys.argv[1:] or HEADLINES
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "pacewell-bench")
    spark.sparkContext.setLogLevel("ERROR")
    run(QUERIES["a09_daily_performance"], spark, sf_dir)  # JVM warm-up
    if SCORING & set(names):
        fitted_model(spark, sf_dir)  # shared by these queries; m13 times a fit
    seconds = {}
    for name in names:
        seconds[name] = round(run(QUERIES[name], spark, sf_dir), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr)
    print(json.dumps({
        "metric": "headline queries, total wall time",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
