"""One query per operator, over the whole of the driver's tables."""

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pacewell.errors import InsufficientDataError
from pacewell.functions.columns import band, iso_text, shown
from pacewell.operators import alerts, analytics, clean, dataset, features, intake, metrics
from pacewell.operators import observability as obs
from pacewell.operators import ranges, rollup, scaling
from pacewell.operators.timeline import counter_increase, hold_state
from pacewell.plans import model as models
from pacewell.plans import dashboard, ingest, published, scoring, training
from pacewell.plans.model import ForestSettings
from pacewell.schemas import CRITICAL, FEATURES, LABEL, RECORD_COLUMNS, SENSORS
from pacewell.session import scratch_path
from pacewell.settings import SERVICES, SERVICES_UP_STEPS, SERVING_DEFAULTS, SUCCESS_RATIO_STEPS
from pacewell.sources import files, tables
from pacewell.sources import testviews as views
from pacewell.streaming import counters, rollups
from pacewell.streaming import jobs as streams
from pacewell.streaming.event_alerts import event_time_alerts, with_state_store

QUERIES = {}

# Walking the trees needs no exchange of sums, so requests are dealt into more tasks than training rows.
PARTITIONS = 32

COUNTER_LABELS = ["job", "method", "endpoint", "status"]


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _six(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Aggregates of doubles depend on addition order past the last digits.

    Means of scores often end in a 5 at the seventh digit, where engines round
    apart; those keep nine digits.
    """
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _keyed(df: DataFrame, *columns: str) -> DataFrame:
    return df.select("record_key", *columns)


def _perf(spark, sf_dir):
    return views.perf_raw(spark, sf_dir)


def _engineered(spark, sf_dir):
    return features.engineer(clean.clean(_perf(spark, sf_dir)))


def _split(spark, sf_dir):
    return training.prepare(_perf(spark, sf_dir),
                            training.TrainingSettings(key_columns=("record_key",)))


def _formula(df):
    return df.withColumn("prediction", F.expr(views.FORMULA_SCORE))


def _requests(spark, sf_dir):
    """Records as scoring requests, with zeros among the optional readings."""
    zeroed = {c: F.when(F.col("recovery_score") == 4.5, F.lit(0.0)).otherwise(F.col(c)) for c in SENSORS}
    return _perf(spark, sf_dir).withColumns(zeroed).withColumn("prediction_date", F.col("record_date"))


# Scans and sinks

@query
def s01_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "s01")
    files.write_csv(_perf(spark, sf_dir), path)
    return files.read_csv(spark, path).select(*RECORD_COLUMNS)


def _uploads(spark, sf_dir, path):
    """Records as uploads with four headers below one folder: all columns, turned round, without sensors, and one that cannot be read."""
    text = _perf(spark, sf_dir).withColumns({c: F.col(c).cast("string") for c in RECORD_COLUMNS})
    headers = [RECORD_COLUMNS, RECORD_COLUMNS[::-1], ["note", *[c for c in RECORD_COLUMNS if c not in SENSORS]],
               [c for c in RECORD_COLUMNS if c != "training_load"]]
    for i, header in enumerate(headers):
        own = text.filter(F.col("recovery_score") / 1.5 % len(headers) == i).withColumn("note", F.lit("n"))
        own.select(*header).write.option("header", True).csv(f"{path}/upload_{i}")


def _read_back(records):
    """Rows and sums by athlete of records that were read, and how many lines were damaged."""
    return records.groupBy(F.coalesce("athlete_id", F.lit("unknown")).alias("athlete_id")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(intake.CORRUPT).alias("n_damaged"), F.count("hrv").alias("n_hrv"),
        F.round(F.sum("training_load"), 4).alias("training_load"), F.max("record_date").alias("last_date"))


@query
def s01_csv_headers(spark, sf_dir):
    """Uploads with different headers in one lenient read."""
    path = scratch_path(spark, "s01-headers")
    _uploads(spark, sf_dir, path)
    return _read_back(files.read_csv(spark, path, strict=False, recursive=True))


@query
def s02_csv_guards(spark, sf_dir):
    path = scratch_path(spark, "s02")
    records = _perf(spark, sf_dir)
    files.write_csv(records, f"{path}/csv")
    # The same lines under another extension must not be read.
    lines = F.to_csv(F.struct(*RECORD_COLUMNS)).alias("value")
    records.select(lines).write.text(f"{path}/other")
    read = files.read_csv(spark, path, strict=False, recursive=True)
    return read.groupBy("athlete_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(intake.CORRUPT).alias("n_damaged"))


@query
def s03_json_scan(spark, sf_dir):
    path = scratch_path(spark, "s03")
    files.write_json_batches(_perf(spark, sf_dir), path)
    return files.read_json_batches(spark, path).select(*RECORD_COLUMNS)


def _damaged_documents(spark, sf_dir):
    """A document per record: some cut short, some without records, some with a text for a number."""
    record = F.to_json(F.struct(*RECORD_COLUMNS))
    document = F.concat(F.lit('{"records":['), record, F.lit("]}"))
    mistyped = F.replace(document, F.lit('"training_load":'), F.lit('"training_load":"heavy","was":'))
    texts = _perf(spark, sf_dir).select("recovery_score", document.alias("whole"), mistyped.alias("mistyped"))
    damaged = (
        F.when(F.col("recovery_score") == 9.0, F.expr("left(whole, length(whole) - 3)"))
        .when(F.col("recovery_score") == 3.0, F.lit('{"other":1}'))
        .when(F.col("recovery_score") == 6.0, F.col("mistyped")).otherwise(F.col("whole")))
    return texts.select(damaged.alias("value"))


@query
def s03_json_damaged(spark, sf_dir):
    """Verdicts over JSON documents of which some are damaged, mistyped or empty: none disappears."""
    path = scratch_path(spark, "s03-damaged")
    _damaged_documents(spark, sf_dir).write.text(path)
    checked = intake.with_violations(files.read_json_batches(spark, path, strict=False))
    first = F.coalesce(F.get("violations", 0), F.lit("none"))
    return checked.groupBy(first.alias("first_violation")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("athlete_id").alias("n_athletes"))


@query
def s04_frame_intake(spark, sf_dir):
    return intake.coerce(_perf(spark, sf_dir)).select(*RECORD_COLUMNS)


@query
def s05_append_records(spark, sf_dir):
    path = scratch_path(spark, "s05")
    records = _perf(spark, sf_dir)
    tables.append_performance(records, path)
    tables.append_performance(records, path)
    return spark.read.parquet(path).groupBy("athlete_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("id").alias("n_ids"),
        F.count("created_at").alias("n_stamped"))


@query
def s06_load_all(spark, sf_dir):
    path = scratch_path(spark, "s06")
    tables.append_performance(_perf(spark, sf_dir), path, by_month=True)
    return tables.load_performance(spark, path)


@query
def s07_prediction_log(spark, sf_dir):
    path = scratch_path(spark, "s07")
    requests = _requests(spark, sf_dir)
    tables.append_predictions(tables.prediction_rows(_formula(scoring.features_for(requests))), path)
    used = F.col("features_used")
    return tables.load_predictions(spark, path).select(
        "athlete_id", "prediction_date", "performance_score", "model_version",
        *[used[c].alias(c) for c in [*CRITICAL, *SENSORS]])


@query
def s08_training_run_log(spark, sf_dir):
    path = scratch_path(spark, "s08")
    groups = metrics.evaluate(_formula(_split(spark, sf_dir))).collect()
    tables.append_training_run(spark, path, sum(g["n_rows"] for g in groups), metrics.metric_map(groups))
    runs = analytics.with_run_metrics(tables.load_training_runs(spark, path))
    return _six(runs.select("model_version", "samples_used", "status", *analytics.RUN_METRICS),
                *analytics.RUN_METRICS)


@query
def s11_batch_limit(spark, sf_dir):
    return intake.oversized_groups(_perf(spark, sf_dir), ["athlete_id"], 600)


# Coercion and validation

@query
def v01_required_columns(spark, sf_dir):
    raw = views.table(spark, sf_dir, "lineitem")
    checked = intake.require_columns(_perf(spark, sf_dir))
    return checked.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "missing_before_mapping", F.lit(",".join(intake.missing_columns(raw))))


def _as_text(spark, sf_dir):
    """Records as text with damage in dates, numbers and ids."""
    damage = {
        "record_date": F.when(F.col("recovery_score") == 9.0, "not a date"),
        "training_load": F.when(F.col("stress_level") == 6.0, "n/a"),
        "athlete_id": F.when(F.col("recovery_score") == 10.5, ""),
        "hrv": F.when(F.col("recovery_score") == 3.0, "NaN"),
    }
    return _perf(spark, sf_dir).withColumns({
        c: F.coalesce(damage.get(c, F.lit(None)), F.col(c).cast("string")) for c in RECORD_COLUMNS})


@query
def v02_coercion(spark, sf_dir):
    typed = intake.coerce(_as_text(spark, sf_dir), strict=False)
    return typed.select("record_key", "athlete_id", "record_date", *CRITICAL, "hrv",
                        F.array_join(intake.PARSE_FAILED, ",").alias("failed"))


@query
def v03_optional_fields(spark, sf_dir):
    df = _perf(spark, sf_dir).drop("hrv")
    nan = F.when(F.col("recovery_score") == 3.0, F.lit(float("nan")))
    df = df.withColumn("resting_heart_rate", F.coalesce(nan, "resting_heart_rate"))
    return _keyed(intake.coerce(df), "resting_heart_rate", "hrv", LABEL)


@query
def v04_rules_ingest(spark, sf_dir):
    return intake.violation_counts(_perf(spark, sf_dir), "ingest")


@query
def v04_row_violations(spark, sf_dir):
    checked = intake.with_violations(_perf(spark, sf_dir), "ingest")
    return _keyed(checked.withColumn("violations", F.array_join("violations", ",")), "violations")


@query
def v05_rules_api(spark, sf_dir):
    return intake.violation_counts(_perf(spark, sf_dir), "api")


@query
def v06_rules_predict(spark, sf_dir):
    return intake.violation_counts(_requests(spark, sf_dir), "predict")


@query
def v07_batch_policy(spark, sf_dir):
    records = _perf(spark, sf_dir)
    verdict = F.when(intake.is_bad(records, "ingest"), "bad").otherwise("good")
    return records.groupBy(verdict.alias("verdict")).agg(F.count(F.lit(1)).alias("n_rows"))


# Cleaning

@query
def v07_whole_batches(spark, sf_dir):
    """An athlete's day as a batch: rows of days without a bad record, and what the refused days held, by first violation."""
    typed = intake.coerce(_perf(spark, sf_dir), strict=False)
    good, refused = intake.split_batches(typed, ["athlete_id", "record_date"])
    kept = good.groupBy("athlete_id", "record_date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(0).cast("long").alias("n_bad"), F.lit("none").alias("first_violation"))
    return kept.unionByName(refused).groupBy("athlete_id", "first_violation").agg(
        F.count(F.lit(1)).alias("n_batches"), F.sum("n_rows").alias("n_rows"), F.sum("n_bad").alias("n_bad"))


@query
def v07_quarantine(spark, sf_dir):
    """Records as text through an intake job that sets bad ones aside: rows of both tables by their first violation."""
    path = scratch_path(spark, "v07-quarantine")
    kept, aside = ingest.ingest_or_quarantine(_as_text(spark, sf_dir), f"{path}/table", f"{path}/bad")
    good = tables.load_performance(spark, f"{path}/table").select(F.lit("none").alias("first_violation"), F.lit(kept).alias("n_told"))
    bad = spark.read.parquet(f"{path}/bad").select(F.get("violations", 0).alias("first_violation"), F.lit(aside).alias("n_told"))
    return good.unionByName(bad).groupBy("first_violation", F.col("n_told").cast("long").alias("n_told")).agg(F.count(F.lit(1)).alias("n_rows"))


@query
def c01_drop_incomplete(spark, sf_dir):
    return _keyed(clean.drop_incomplete(_perf(spark, sf_dir)), *CRITICAL)


@query
def c02_clip_critical(spark, sf_dir):
    return _keyed(clean.clip_critical(_perf(spark, sf_dir)), *CRITICAL)


@query
def c03_clip_sensors(spark, sf_dir):
    return _keyed(clean.clip_sensors(_perf(spark, sf_dir)), *SENSORS)


@query
def c04_clean(spark, sf_dir):
    return _keyed(clean.clean(_perf(spark, sf_dir)), *RECORD_COLUMNS)


# Features

@query
def f01_median_fill(spark, sf_dir):
    cleaned = clean.clean(_perf(spark, sf_dir))
    filled = features.fill_sensors(cleaned, features.fit_fill_values(cleaned))
    return _keyed(filled, "resting_heart_rate_filled", "hrv_filled")


@query
def f02_constant_fill(spark, sf_dir):
    cleaned = clean.clean(_perf(spark, sf_dir)).drop(*SENSORS)
    filled = features.fill_sensors(cleaned, features.fit_fill_values(cleaned))
    return _keyed(filled, "resting_heart_rate_filled", "hrv_filled")


@query
def f03_sleep_recovery_ratio(spark, sf_dir):
    return _keyed(features.add_ratios(clean.clean(_perf(spark, sf_dir))), "sleep_recovery_ratio")


@query
def f04_load_stress_ratio(spark, sf_dir):
    return _keyed(features.add_ratios(clean.clean(_perf(spark, sf_dir))), "load_stress_ratio")


@query
def f05_serving_defaults(spark, sf_dir):
    return _keyed(features.serving_features(_perf(spark, sf_dir)),
                  *CRITICAL, "resting_heart_rate_filled", "hrv_filled")


@query
def f06_falsy_defaults(spark, sf_dir):
    return _keyed(features.request_defaults(_requests(spark, sf_dir)), *SENSORS)


@query
def f07_serving_features(spark, sf_dir):
    return features.align(features.serving_features(_perf(spark, sf_dir)), "record_key")


@query
def f08_feature_alignment(spark, sf_dir):
    return features.align(_engineered(spark, sf_dir), "record_key")


# Datasets

@query
def d01_labelled(spark, sf_dir):
    return _keyed(dataset.labelled(_perf(spark, sf_dir)), LABEL)


@query
def d02_minimum_rows(spark, sf_dir):
    """What a too small and an empty training set are refused with, and that the whole one is not."""
    labelled = dataset.labelled(_perf(spark, sf_dir))
    few = labelled.filter(F.col("record_key").isin([r[0] for r in labelled.select("record_key").limit(7).collect()]))
    rows = []
    for name, rows_of in (("few", few), ("none", labelled.filter(F.lit(False))), ("all", labelled)):
        try:
            dataset.require_labelled(rows_of)
        except InsufficientDataError as refused:
            rows.append((name, refused.required, refused.actual))
    return spark.createDataFrame(rows, "subset string, required int, actual int")


@query
def d03_hash_split(spark, sf_dir):
    return _keyed(dataset.hash_split(_perf(spark, sf_dir), ["record_key"]), "split")


@query
def d04_exact_split(spark, sf_dir):
    return _keyed(dataset.exact_split(_perf(spark, sf_dir), ["record_key"]), "split")


@query
def d05_sample_counts(spark, sf_dir):
    return dataset.sample_counts(_split(spark, sf_dir).select("split", *FEATURES, LABEL))


@query
def d06_full_dataset(spark, sf_dir):
    totals = _split(spark, sf_dir).groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.sum(c).alias(f"sum_{c}") for c in [*FEATURES, LABEL]])
    return totals.withColumns({f"sum_{c}": F.round(f"sum_{c}", 3) for c in [*FEATURES, LABEL]})


# Model

@query
def m01_scaler_fit(spark, sf_dir):
    train = _split(spark, sf_dir).filter("split = 'train'")
    return _six(scaling.scale_statistics(train), "mean", "std")


@query
def m02_scale(spark, sf_dir):
    rows = _split(spark, sf_dir)
    scaled = scaling.standardize(rows, scaling.fit_scales(rows.filter("split = 'train'")))
    names = [f"{f}_scaled" for f in FEATURES]
    return _six(_keyed(scaled, *names), *names)


SETTINGS = training.TrainingSettings(key_columns=("record_key",))


@functools.cache
def _fitted(application: str, sf_dir: str):
    """The model in memory and its path: fitted once per application for the queries that use one."""
    spark = SparkSession.active()
    fitted = models.fit(_split(spark, sf_dir).filter("split = 'train'"), SETTINGS.forest)
    path = scratch_path(spark, "model")
    models.save(fitted, path)
    return fitted, path


def fitted_model(spark, sf_dir):
    return _fitted(spark.sparkContext.applicationId, sf_dir)


def _possible(spark, sf_dir, score: str):
    """Marks scores that a mean of training labels can be: within their range."""
    train = _split(spark, sf_dir).filter("split = 'train'")
    low, high = train.agg(F.min(LABEL), F.max(LABEL)).first()
    return F.count(F.when(F.col(score).between(low, high), 1)).alias("n_possible")


@query
def m03_forest_fit(spark, sf_dir):
    fitted, _ = fitted_model(spark, sf_dir)
    rows = models.dealt(_split(spark, sf_dir).select("split", *FEATURES, LABEL), PARTITIONS)
    trees = [t for part in models.forests(fitted) for t in part.trees]
    groups = metrics.evaluate(models.score(fitted, rows))
    return groups.select(
        "split", "n_rows", F.lit(len(trees)).alias("n_trees"), F.lit(max(t.depth for t in trees)).alias("depth"),
        (F.col("r2") >= 0.9).cast("int").alias("is_good"))


@query
def m04_batch_predict(spark, sf_dir):
    """Per athlete: scores in the range of the labels, and labels the scores come close to."""
    model = models.load(fitted_model(spark, sf_dir)[1])
    rows = models.dealt(_engineered(spark, sf_dir), PARTITIONS, ["record_key"])
    far = F.abs(F.col("prediction") - F.col(LABEL)) > 15
    return models.score(model, rows).groupBy("athlete_id").agg(
        F.count(F.lit(1)).alias("n_rows"), _possible(spark, sf_dir, "prediction"),
        F.count(F.when(far, 1)).alias("n_far"))


@query
def s10_model_store(spark, sf_dir):
    fitted, path = fitted_model(spark, sf_dir)
    rows = models.dealt(_split(spark, sf_dir), PARTITIONS, ["record_key"])
    before = models.score(fitted, rows).withColumnRenamed("prediction", "fitted")
    both = models.score(models.load(path), before)
    return both.agg(F.count(F.lit(1)).alias("n_rows"),
                    F.count(F.when(F.col("fitted") == F.col("prediction"), 1)).alias("n_equal"))


def _formula_metrics(spark, sf_dir):
    rows = _formula(dataset.labelled(clean.clean(_perf(spark, sf_dir))))
    return metrics.evaluate(rows, by=())


@query
def m06_mae(spark, sf_dir):
    return _six(_formula_metrics(spark, sf_dir).select("mae"), "mae")


@query
def m07_rmse(spark, sf_dir):
    return _six(_formula_metrics(spark, sf_dir).select("rmse"), "rmse")


@query
def m08_r2(spark, sf_dir):
    return _six(_formula_metrics(spark, sf_dir).select("r2"), "r2")


@query
def m09_metric_rows(spark, sf_dir):
    scored = _formula(_split(spark, sf_dir))
    return _six(metrics.long_form(metrics.evaluate(scored)), "value")


@query
def m11_version_stamp(spark, sf_dir):
    rows = tables.prediction_rows(_formula(scoring.features_for(_requests(spark, sf_dir))))
    return rows.groupBy("model_version").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def m12_rounded_answer(spark, sf_dir):
    scored = _formula(clean.clean(_perf(spark, sf_dir)))
    scored = scored.withColumn("prediction", F.round(F.col("prediction") / 7, 6))
    return _keyed(scored.withColumn("score", models.rounded()), "score")


@query
def m13_train_job(spark, sf_dir):
    runs = scratch_path(spark, "m13-runs")
    training.train_job(spark, _perf(spark, sf_dir), scratch_path(spark, "m13-model"), runs, SETTINGS)
    run = tables.load_training_runs(spark, runs)
    rows = run.select("status", "model_version", "samples_used", F.explode("metrics").alias("metric", "value"))
    # The values depend on the trees; what must hold is that they are good.
    good = F.when(F.col("metric").endswith("r2"), F.col("value").between(0.9, 1.0)).otherwise(
        F.col("value").between(0.0, 5.0))
    return rows.select("status", "model_version", "samples_used", "metric", good.cast("int").alias("is_good"))


def _far_from_label(log):
    """Marks logged scores that are more than 15 off the label that the logged inputs stand for."""
    of = {c: F.col("features_used").getItem(c) for c in ("sleep_hours", "sleep_quality", "stress_level", "recovery_score", "training_load")}
    label = (40 + 3 * of["sleep_quality"] - 2 * of["stress_level"] + of["sleep_hours"]
             + of["recovery_score"] / 0.75 - of["training_load"] / 50)
    label = F.when(label < 0, 0.0).when(label > 100, 100.0).otherwise(label)
    return F.count(F.when(F.abs(F.col("performance_score") - label) > 15, 1)).alias("n_far")


@query
def m14_score_job(spark, sf_dir):
    """Per athlete: logged answers, those in the range of the labels, those far from their labels, and whether answers are the rounded log."""
    log = scratch_path(spark, "m14-log")
    given = scoring.score_job(_requests(spark, sf_dir), fitted_model(spark, sf_dir)[1], log, partitions=PARTITIONS)
    logged = tables.load_predictions(spark, log)
    sums = logged.groupBy("athlete_id").agg(
        F.count(F.lit(1)).alias("n_rows"), _possible(spark, sf_dir, "performance_score"), _far_from_label(logged),
        F.sum(F.round("performance_score", 2).cast("decimal(20,2)")).alias("logged"))
    answered = given.groupBy("athlete_id").agg(F.sum(F.col("performance_score").cast("decimal(20,2)")).alias("given"))
    return sums.join(answered, "athlete_id").select(
        "athlete_id", "n_rows", "n_possible", "n_far", (F.col("logged") == F.col("given")).cast("int").alias("is_equal"))


def _rescored(log, model):
    """Logged rows and those whose score the model gives again for the logged inputs."""
    inputs = log.select("performance_score", *[F.col("features_used").getItem(c).alias(c) for c in SERVING_DEFAULTS])
    again = models.score(model, scoring.features_for(inputs))
    return again.agg(F.count(F.lit(1)).alias("n_rows"),
                     F.count(F.when(F.col("prediction") == F.col("performance_score"), 1)).alias("n_equal"))


@query
def m11_published_versions(spark, sf_dir):
    """A stream scores half of the records, another version is published, and it scores the rest: rows by version, all as that version scores them."""
    path = scratch_path(spark, "m11")
    root, log = f"{path}/models", f"{path}/log"
    train = _split(spark, sf_dir).filter("split = 'train'")
    requests = _perf(spark, sf_dir).withColumn("prediction_date", F.col("record_date"))
    odd = F.substring_index("record_key", "-", 1).cast("long") % 2
    forests = {version: ForestSettings(trees=3 + 2 * i, depth=4) for i, version in enumerate(("2.0", "2.1"))}
    with models.prepared(train) as ready:
        fitted = {version: models.fit_prepared(ready, settings) for version, settings in forests.items()}
    for i, (version, model) in enumerate(fitted.items()):
        published.publish(model, root, version)
        requests.filter(odd == i).write.mode("append").parquet(f"{path}/in")
        arriving = spark.readStream.schema(requests.schema).parquet(f"{path}/in")
        _finish(streams.published_scoring_stream(arriving, root, log, f"{path}/checkpoint", partitions=PARTITIONS))
    logged = tables.load_predictions(spark, log)
    found = [_rescored(logged.filter(F.col("model_version") == v), published.load_version(root, v)).withColumn("model_version", F.lit(v))
             for v in ("2.0", "2.1")]
    return functools.reduce(DataFrame.unionByName, found)


@query
def m14_score_formula(spark, sf_dir):
    scored = _formula(scoring.features_for(_requests(spark, sf_dir)))
    scored = scored.withColumn("prediction", F.round("prediction", 6))
    return scoring.answers(tables.prediction_rows(scored))


# Dashboard

@query
def a01_latest_predictions(spark, sf_dir):
    return analytics.latest_predictions(views.predictions(spark, sf_dir))


@query
def a02_latest_training_runs(spark, sf_dir):
    return analytics.latest_training_runs(views.training_runs(spark, sf_dir))


@query
def a03_latest_history(spark, sf_dir):
    ties = ("record_key", *[c for c in RECORD_COLUMNS if c != "record_date"])
    return analytics.latest_history(_perf(spark, sf_dir), ties=ties)


@query
def a04_prediction_figures(spark, sf_dir):
    return analytics.prediction_figures(views.predictions(spark, sf_dir))


@query
def a04_prediction_figures_page(spark, sf_dir):
    return dashboard.predictions_page(views.predictions(spark, sf_dir)).figures


@query
def a05_latest_run_figures(spark, sf_dir):
    latest = analytics.latest_run_figures(views.training_runs(spark, sf_dir))
    return latest.withColumns({f"{m}_shown": shown(F.col(m)) for m in analytics.RUN_METRICS})


@query
def a06_athlete_list(spark, sf_dir):
    return analytics.athlete_ids(_perf(spark, sf_dir))


@query
def a06_default_athletes(spark, sf_dir):
    return analytics.athlete_ids(_perf(spark, sf_dir), 5)


@query
def a07_athlete_filter(spark, sf_dir):
    perf = _perf(spark, sf_dir)
    first = [r["athlete_id"] for r in analytics.athlete_ids(perf, 5).collect()]
    return analytics.for_athletes(perf, first).select("record_key", *RECORD_COLUMNS)


@query
def a08_history_figures(spark, sf_dir):
    return analytics.history_figures(_perf(spark, sf_dir))


@query
def a09_daily_means(spark, sf_dir):
    means = analytics.daily_means(_perf(spark, sf_dir))
    return _six(means, f"mean_{LABEL}", digits=9)


@query
def a09_daily_means_rollup(spark, sf_dir):
    """Daily means from partials that a stream of three micro-batches kept, without a record being read again."""
    path = scratch_path(spark, "a09-rollup")
    records = _perf(spark, sf_dir)
    for i in range(3):
        part = F.pmod(F.xxhash64("record_key"), F.lit(3)) == i
        records.filter(part).write.mode("append").parquet(f"{path}/in/part_{i}")
    arriving = spark.readStream.schema(records.schema).option("maxFilesPerTrigger", 4).parquet(f"{path}/in/*")
    _finish(rollups.rollup_stream(arriving, f"{path}/out", f"{path}/checkpoint"))
    means = rollup.daily_means(rollups.read_rollup(spark, f"{path}/out"))
    return _six(means, f"mean_{LABEL}", digits=9)


def _partials(spark, sf_dir):
    path = scratch_path(spark, "partials")
    rollup.daily_partials(_perf(spark, sf_dir)).write.parquet(path)
    return spark.read.parquet(path)


@query
def a08_history_rollup(spark, sf_dir):
    """Figures of each month from daily partials; is the distinct count within its bound of the exact one?"""
    month = F.date_format("record_date", "yyyy-MM").alias("month")
    found = rollup.history_figures(_partials(spark, sf_dir).withColumn("month", month), "month")
    exact = _perf(spark, sf_dir).groupBy(month).agg(F.count_distinct("athlete_id").alias("exact"))
    near = F.abs(F.col("athletes") - F.col("exact")) <= rollup.DISTINCT_ERROR * F.col("exact")
    return found.join(exact, "month").select("month", "records", "first_date", "last_date", near.cast("int").alias("is_near"))


@query
def f01_median_sketch(spark, sf_dir):
    """Medians of the sensors from daily partials; is their rank within its bound?"""
    partials, records = _partials(spark, sf_dir), _perf(spark, sf_dir)
    medians = {c: rollup.quantiles(partials, c, {"median": 0.5}).first()["median"] for c in SENSORS}
    counted = [records.filter(F.col(c).isNotNull()).agg(
        F.lit(c).alias("sensor"), F.count(F.lit(1)).alias("n_values"),
        ((F.count_if(F.col(c) < medians[c]) <= (0.5 + rollup.RANK_ERROR) * F.count(F.lit(1)))
         & (F.count_if(F.col(c) <= medians[c]) >= (0.5 - rollup.RANK_ERROR) * F.count(F.lit(1)))).cast("int").alias("is_near"))
        for c in SENSORS]
    return functools.reduce(DataFrame.unionByName, counted)


@query
def a09_history_page(spark, sf_dir):
    ties = ("record_key", *[c for c in RECORD_COLUMNS if c != "record_date"])
    return _six(dashboard.history_page(_perf(spark, sf_dir), ties=ties).series, "value", digits=9)


@query
def a08_history_page_figures(spark, sf_dir):
    ties = ("record_key", *[c for c in RECORD_COLUMNS if c != "record_date"])
    return dashboard.history_page(_perf(spark, sf_dir), ties=ties).figures


@query
def a05_training_page_figures(spark, sf_dir):
    return dashboard.training_page(views.training_runs(spark, sf_dir)).figures


@query
def a10_series_in_order(spark, sf_dir):
    return analytics.series_in_order(views.predictions(spark, sf_dir), "created_at", "id").select("id", "created_at", "performance_score")


@query
def a11_melted_runs(spark, sf_dir):
    runs = analytics.with_run_metrics(views.training_runs(spark, sf_dir))
    return analytics.melt(runs, ["id", "run_date"], [*analytics.RUN_METRICS, "not_a_column"])


@query
def a13_previews(spark, sf_dir):
    ids = [
        analytics.preview(df.select(F.col(key).cast("string").alias("row_id"), time), n,
                          time, "row_id").select("row_id", F.lit(page).alias("page"))
        for df, key, time, n, page in (
            (views.predictions(spark, sf_dir), "id", "created_at", 180, "predictions"),
            (views.training_runs(spark, sf_dir), "id", "run_date", 120, "training_runs"),
            (_perf(spark, sf_dir), "record_key", "record_date", 240, "history"))
    ]
    return ids[0].unionByName(ids[1]).unionByName(ids[2])


@query
def a14_lenient_time(spark, sf_dir):
    text = views.predictions(spark, sf_dir).select("id", F.when(
        F.col("id") % 11 == 0, "pending").otherwise(F.col("created_at").cast("string")).alias("created_at"))
    return analytics.lenient_timestamp(text, "created_at")


@query
def a15_iso_time(spark, sf_dir):
    rows = views.predictions(spark, sf_dir).select(
        "id", F.when(F.col("id") % 11 != 0, F.col("created_at")).alias("created_at"))
    return rows.withColumn("created_at", iso_text(F.col("created_at")))


# Service metrics

def _log(spark, sf_dir):
    return obs.measured(views.request_log(spark, sf_dir))


@query
def o01_measured_requests(spark, sf_dir):
    return _log(spark, sf_dir)


@query
def o02_request_rate(spark, sf_dir):
    return obs.request_rate(obs.matching(_log(spark, sf_dir), {"job": "api"}), ["method", "endpoint"])


@query
def o02_sliding_rate(spark, sf_dir):
    return obs.request_rate(obs.matching(_log(spark, sf_dir), {"job": "api"}), ["endpoint"],
                            width=3600, slide=900)


@query
def o03_latency_histogram(spark, sf_dir):
    keys = ["method", "endpoint"]
    return obs.histogram_rows(obs.latency_histogram(_log(spark, sf_dir), keys), keys)


@query
def o04_latency_quantiles(spark, sf_dir):
    api = obs.matching(_log(spark, sf_dir), {"job": "api"})
    return obs.latency_quantiles(api, ["endpoint"])


@query
def o04_quantiles_of_buckets(spark, sf_dir):
    """Quantiles from bucket counts in long form, summed over methods."""
    keys = ["method", "endpoint", "window_start"]
    api = obs.matching(_log(spark, sf_dir), {"job": "api"})
    buckets = obs.histogram_rows(obs.latency_histogram(api, ["method", "endpoint"], 300), keys)
    return obs.quantiles_of_buckets(buckets, ["endpoint"], value="n_requests")


@query
def o05_services_up(spark, sf_dir):
    return obs.services_up(views.up_samples(spark, sf_dir), "|".join(SERVICES))


@query
def o06_predictions_per_hour(spark, sf_dir):
    return obs.request_increase(obs.matching(_log(spark, sf_dir), {"job": "api", "endpoint": "/predict"}))


@query
def o06_range_increase(spark, sf_dir):
    """Increase over the hour before every fifth minute, of counters that restart every day."""
    found = ranges.range_increase(views.counter_samples(spark, sf_dir), COUNTER_LABELS, "ts", "v", 300, 3600, ["event_id"])
    return _six(found, "increase", "rate")


@query
def o05_services_up_lookback(spark, sf_dir):
    """Services up at every quarter of an hour; each answer of a service is a sample that counts for half an hour."""
    answers = obs.matching(views.request_log(spark, sf_dir), patterns={"job": "|".join(SERVICES)})
    samples = answers.withColumn("up", F.when(F.col("status") == "200", F.lit(1)).otherwise(F.lit(0)))
    return ranges.services_up_at(samples, 900, 1800, ties=["event_id"])


@query
def o07_trainings_per_day(spark, sf_dir):
    log = obs.matching(_log(spark, sf_dir), {"job": "api", "endpoint": "/train", "status": "200"})
    return obs.request_increase(log, width=86400)


@query
def o08_requests_per_minute(spark, sf_dir):
    return obs.request_rate(_log(spark, sf_dir), scale=60.0)


@query
def o08_requests_per_second(spark, sf_dir):
    return obs.request_rate(_log(spark, sf_dir))


@query
def o09_rate_by_endpoint(spark, sf_dir):
    log = obs.matching(_log(spark, sf_dir), patterns={"job": "data-ingestion|ml-trainer"})
    return obs.request_rate(log, ["job", "endpoint"])


@query
def o10_success_ratio(spark, sf_dir):
    return obs.success_ratio(_log(spark, sf_dir))


@query
def o11_trainer_quantiles(spark, sf_dir):
    log = obs.matching(_log(spark, sf_dir), {"job": "ml-trainer"})
    return obs.latency_quantiles(log)


@query
def o11_overall_p95(spark, sf_dir):
    return obs.latency_quantiles(_log(spark, sf_dir), phis={"p95": 0.95})


@query
def o12_counter_increase(spark, sf_dir):
    samples = views.counter_samples(spark, sf_dir)
    return counter_increase(samples, COUNTER_LABELS, "ts", "v", 3600, ties=["event_id"])


@query
def o13_label_matchers(spark, sf_dir):
    log = obs.matching(_log(spark, sf_dir), patterns={"job": "api|data-ingestion", "status": "5.."})
    return log.groupBy("job", "status").agg(F.count(F.lit(1)).alias("n_requests"))


@query
def o14_threshold_bands(spark, sf_dir):
    up = views.up_samples(spark, sf_dir).groupBy("ts").agg(F.sum("up").cast("double").alias("value"))
    ratio = obs.success_ratio(_log(spark, sf_dir), width=3600)
    return (
        up.select(F.lit("services_up").alias("panel"), "ts", "value",
                  band(F.col("value"), SERVICES_UP_STEPS).alias("colour"))
        .unionByName(ratio.select(
            F.lit("success_ratio").alias("panel"), F.col("window_start").alias("ts"),
            F.col("success_ratio").alias("value"),
            band(F.col("success_ratio"), SUCCESS_RATIO_STEPS).alias("colour")))
    )


@query
def o15_service_down(spark, sf_dir):
    return alerts.service_down(views.up_samples(spark, sf_dir))


@query
def o16_hold_state(spark, sf_dir):
    api = obs.matching(views.request_log(spark, sf_dir), {"job": "api"})
    ratio = obs.error_ratio(api, width=3600).withColumn("series", F.lit("api"))
    return hold_state(ratio, ["series"], "window_start", F.col("value") > 0.05, 7200).drop("series")


@query
def o17_high_latency(spark, sf_dir):
    return alerts.high_latency(_log(spark, sf_dir))


@query
def o18_high_error_rate(spark, sf_dir):
    return alerts.high_error_rate(_log(spark, sf_dir))


@query
def o20_last_known(spark, sf_dir):
    runs = analytics.with_run_metrics(views.training_runs(spark, sf_dir))
    return obs.last_known(runs, ["model_version"], "test_mae", "run_date", "id")


# Streams

def _finish(stream):
    stream.awaitTermination()
    return stream


def _taken_in(spark, stream, path):
    """Verdicts and first violations of what an intake stream wrote."""
    _finish(streams.intake_stream(stream, f"{path}/good", f"{path}/bad", f"{path}/checkpoint"))
    good = spark.read.parquet(f"{path}/good").select(F.lit("none").alias("first_violation"), "athlete_id")
    bad = spark.read.parquet(f"{path}/bad").select(F.get("violations", 0).alias("first_violation"), "athlete_id")
    return good.unionByName(bad).groupBy("first_violation").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("athlete_id").alias("n_athletes"))


@query
def t01_intake_stream(spark, sf_dir):
    path = scratch_path(spark, "t01")
    files.write_csv(_perf(spark, sf_dir), f"{path}/in")
    return _taken_in(spark, streams.csv_stream(spark, f"{path}/in"), path)


@query
def t01_csv_headers_stream(spark, sf_dir):
    """Uploads with different headers as a stream, good and bad rows together again."""
    path = scratch_path(spark, "t01-headers")
    _uploads(spark, sf_dir, f"{path}/in")
    stream = streams.csv_stream(spark, f"{path}/in", recursive=True)
    _finish(streams.intake_stream(stream, f"{path}/good", f"{path}/bad", f"{path}/checkpoint"))
    bad = spark.read.parquet(f"{path}/bad").select(*RECORD_COLUMNS, intake.CORRUPT)
    return _read_back(spark.read.parquet(f"{path}/good").select(*RECORD_COLUMNS).unionByName(bad, allowMissingColumns=True))


@query
def t01_whole_files_stream(spark, sf_dir):
    """One file per upload, two of them with bad records: rows taken in by athlete, and what the refused files held."""
    path = scratch_path(spark, "t01-files")
    order = F.element_at(F.split("record_key", "-"), 1).cast("long")
    records = clean.clean(_perf(spark, sf_dir)).withColumn("upload", order % 13)
    bad = F.col("upload").isin(3, 7) & (F.element_at(F.split("record_key", "-"), 4) == "2")
    records = records.withColumn("sleep_quality", F.when(bad, F.lit(0.5)).otherwise(F.col("sleep_quality")))
    laid = records.select(*RECORD_COLUMNS, "upload").repartition(13, "upload")
    laid.write.partitionBy("upload").option("header", True).csv(f"{path}/in")
    stream = streams.csv_stream(spark, f"{path}/in", max_files=4, recursive=True)
    _finish(streams.intake_stream(stream, f"{path}/good", f"{path}/bad", f"{path}/checkpoint", whole_files=True))
    taken = spark.read.parquet(f"{path}/good").groupBy(F.col("athlete_id").alias("name")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(0).cast("long").alias("n_bad"), F.lit("none").alias("first_violation"))
    refused = spark.read.parquet(f"{path}/bad").groupBy(
        F.regexp_extract(files.SOURCE_FILE, "upload=([0-9]+)", 0).alias("name"), "first_violation").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n_bad").alias("n_bad"))
    return taken.unionByName(refused)


@query
def t01_json_stream(spark, sf_dir):
    path = scratch_path(spark, "t01-json")
    _damaged_documents(spark, sf_dir).write.text(f"{path}/in")
    return _taken_in(spark, streams.json_stream(spark, f"{path}/in"), path)


def _log_stream(spark, sf_dir):
    return obs.measured(views.as_request_log(views.stream(spark, sf_dir, "events")))


@query
def t02_rate_stream(spark, sf_dir):
    path = scratch_path(spark, "t02")
    api = obs.matching(_log_stream(spark, sf_dir), {"job": "api"})
    rates = streams.rate_stream(api, ["method", "endpoint"])
    _finish(streams.append_stream(rates, f"{path}/out", f"{path}/checkpoint"))
    return spark.read.schema(rates.schema).parquet(f"{path}/out")


@query
def t02_counter_increase_stream(spark, sf_dir):
    """Samples that arrive up to five minutes late, in four micro-batches; hours that are over at the end."""
    path = scratch_path(spark, "t02-counter")
    samples = views.counter_samples(spark, sf_dir)
    arrival = F.unix_seconds("ts") + F.pmod(F.xxhash64("event_id"), F.lit(300))
    samples.withColumn("arrival", arrival).write.parquet(f"{path}/samples")
    samples = spark.read.parquet(f"{path}/samples")
    span = samples.agg(F.min("arrival").alias("first"), F.max("arrival").alias("last"), F.max("ts").alias("end")).first()
    part = F.floor((F.col("arrival") - span["first"]) * 4 / (span["last"] - span["first"] + 1))
    for i in range(4):
        samples.filter(part == i).coalesce(1).write.mode("append").parquet(f"{path}/in")
    arriving = spark.readStream.schema(samples.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    panes = counters.counter_panes(arriving, COUNTER_LABELS, "10 minutes", ties=["event_id"])
    _finish(counters.counter_increase_stream(panes, COUNTER_LABELS, 3600, f"{path}/out", f"{path}/state", f"{path}/checkpoint"))
    found = counters.read_counter_increase(spark, f"{path}/out", COUNTER_LABELS, 3600)
    over = F.lit(span["end"]) - F.expr("INTERVAL 10 MINUTES")
    return found.filter(F.col("window_start") + F.expr("INTERVAL 1 HOUR") <= over)


@query
def t03_scoring_stream(spark, sf_dir):
    path = scratch_path(spark, "t03")
    records = views.as_perf_raw(views.stream(spark, sf_dir, "lineitem"))
    requests = records.withColumn("prediction_date", F.col("record_date"))
    _finish(streams.scoring_stream(requests, fitted_model(spark, sf_dir)[1], f"{path}/log",
                                   f"{path}/checkpoint", partitions=PARTITIONS))
    log = tables.load_predictions(spark, f"{path}/log")
    return log.groupBy("athlete_id", "prediction_date", "model_version").agg(
        F.count(F.lit(1)).alias("n_rows"), _possible(spark, sf_dir, "performance_score"), _far_from_label(log))


@query
def t04_alert_stream(spark, sf_dir):
    path = scratch_path(spark, "t04")
    api = obs.matching(_log_stream(spark, sf_dir), {"job": "api"})
    ratio = streams.error_ratio_stream(api)
    _finish(streams.alert_stream(ratio, alerts.HIGH_ERROR_RATE, f"{path}/out", f"{path}/state",
                                 f"{path}/checkpoint", max_gap=300))
    return spark.read.parquet(f"{path}/out").drop("batch_id")


@query
def t04_latency_alert_stream(spark, sf_dir):
    path = scratch_path(spark, "t04-latency")
    api = obs.matching(_log_stream(spark, sf_dir), {"job": "api"})
    _finish(streams.alert_stream(streams.latency_stream(api), alerts.HIGH_LATENCY, f"{path}/out",
                                 f"{path}/state", f"{path}/checkpoint", max_gap=300))
    return spark.read.parquet(f"{path}/out").drop("batch_id")


@query
def t04_service_down_stream(spark, sf_dir):
    path = scratch_path(spark, "t04-up")
    samples = views.up_samples(spark, sf_dir)
    samples.write.parquet(f"{path}/in")
    arriving = spark.readStream.schema(samples.schema).parquet(f"{path}/in")
    _finish(streams.alert_stream(arriving, alerts.SERVICE_DOWN, f"{path}/out", f"{path}/state",
                                 f"{path}/checkpoint", keys=["job"], ts="ts", value="up", slice_seconds=3600))
    return spark.read.parquet(f"{path}/out").drop("batch_id")


@query
def t04_event_alert_stream(spark, sf_dir):
    """Samples that arrive up to three hours late, in six micro-batches; what the watermark has passed at the end."""
    path = scratch_path(spark, "t04-event")
    samples = views.up_samples(spark, sf_dir)
    # Hours since the epoch; a sixth of the time that all samples span is a micro-batch.
    hour = F.floor(F.unix_seconds("ts") / 3600) + F.pmod(F.xxhash64("job", "ts"), F.lit(4))
    span = samples.agg(F.min(hour).alias("first"), F.max(hour).alias("last"), F.max("ts").alias("end")).first()
    part = F.floor((hour - span["first"]) * 6 / (span["last"] - span["first"] + 1))
    for i in range(6):
        samples.filter(part == i).coalesce(1).write.mode("append").parquet(f"{path}/in")
    arriving = spark.readStream.schema(samples.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    states = event_time_alerts(arriving, alerts.SERVICE_DOWN, ["job"], "4 hours", value="up")
    _finish(with_state_store(spark, lambda: streams.append_stream(states, f"{path}/out", f"{path}/checkpoint")))
    passed = F.lit(span["end"]) - F.expr("INTERVAL 4 HOURS")
    return spark.read.schema(states.schema).parquet(f"{path}/out").filter(F.col("ts") < passed)


def daily_performance(spark, sf_dir):
    """Flagship: clean, features, daily means of label and ratios."""
    means = analytics.daily_means(_engineered(spark, sf_dir), "sleep_recovery_ratio", "load_stress_ratio")
    return _six(means, *[c for c in means.columns if c != "record_date"], digits=9)


QUERIES["a09_daily_performance"] = daily_performance
