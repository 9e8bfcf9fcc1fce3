"""Listings, key figures and series for the dashboard."""

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacewell.functions.columns import iso_text, known
from pacewell.operators.order_stats import select_ranks
from pacewell.schemas import LABEL, RECORD_COLUMNS

RUN_METRICS = ["test_mae", "test_rmse", "test_r2"]


def latest(df: DataFrame, n: int | None, by: str, *ties: str) -> DataFrame:
    """Last ``n`` rows by time, newest first; all of them for ``None``.

    The tie columns make the choice unique. Rows are counted per day first, so
    that a filter on the time, which the scan can use, leaves only the days the
    newest rows are from. Where the last such day is a hot one, as after a bulk
    load, the time that its wanted rows reach back to is found by counting too.
    Sort and limit then see little more than ``n`` rows, and those of one instant.
    """
    order = [F.desc(by), *[F.desc(t) for t in ties]]
    if n is None:
        return df.orderBy(*order)
    if n < 1:
        raise ValueError("a listing has at least one row")
    since = _since(df, n, by)
    return (df if since is None else df.filter(F.col(by) >= since)).orderBy(*order).limit(n)


# A day of more rows than this for each wanted one is searched for the time within it.
HOT_DAY = 16


def _since(df: DataFrame, n: int, by: str) -> Column | None:
    """A time after which the newest ``n`` rows are; ``None`` if there are fewer rows with a time."""
    # One row per day of the calendar.
    days = df.filter(F.col(by).isNotNull()).groupBy(F.to_date(by).alias("day")).agg(F.count(F.lit(1)).alias("n"))
    seen = 0
    for day in sorted(days.collect(), key=lambda r: r["day"], reverse=True):
        seen += day["n"]
        if seen >= n:
            if day["n"] > HOT_DAY * n and df.schema[by].dataType.typeName() != "date":
                return _within_day(df, day["day"], seen - n, by)
            return F.lit(day["day"])
    return None


def _within_day(df: DataFrame, day: date, rank: int, by: str) -> Column:
    """The time at a rank, from 0, of the rows since a day."""
    kind = df.schema[by].dataType
    start = F.lit(day).cast("timestamp")
    begun = df.sparkSession.range(1).select(F.unix_micros(start)).first()[0]
    us = F.unix_micros(F.col(by).cast("timestamp"))
    (cut,) = select_ranks(df.filter(F.col(by) >= F.lit(day)), {by: (us, "long", begun, begun + 86_400_000_000)}, lambda total: [rank])[by]
    return F.timestamp_micros(F.lit(cut.value)).cast(kind)


def latest_predictions(predictions: DataFrame, limit: int | None = 500) -> DataFrame:
    top = latest(predictions, limit, "created_at", "id")
    return top.select("id", "athlete_id", "prediction_date", "performance_score",
                      "model_version", iso_text(F.col("created_at")).alias("created_at"))


def run_metric(df: DataFrame, name: str):
    """One metric of a run, from the map or from its JSON text; else NULL."""
    if df.schema["metrics"].dataType.typeName() == "map":
        return F.col("metrics")[name]
    return F.get_json_object("metrics", f"$.{name}").cast("double")


def with_run_metrics(runs: DataFrame) -> DataFrame:
    return runs.withColumns({m: run_metric(runs, m) for m in RUN_METRICS})


def latest_training_runs(runs: DataFrame, limit: int | None = 100) -> DataFrame:
    """Metrics are extracted after the limit, so from ``limit`` rows only."""
    top = with_run_metrics(latest(runs, limit, "run_date", "id"))
    return top.select(iso_text(F.col("run_date")).alias("run_date"), "model_version",
                      "samples_used", *RUN_METRICS, "status")


def latest_history(records: DataFrame, limit: int | None = 5000, ties=("athlete_id",)) -> DataFrame:
    return latest(records, limit, "record_date", *ties).select(*RECORD_COLUMNS)


def prediction_figures(predictions: DataFrame) -> DataFrame:
    """Row count, newest score and distinct athletes.

    The newest score is a top-1 of its own: beside the counts it would turn
    their hash aggregate into one that sorts every row.
    """
    newest = predictions.orderBy(F.desc("created_at"), F.desc("id")).limit(1).select("performance_score")
    counts = predictions.agg(
        F.count(F.lit(1)).alias("total_predictions"), F.count_distinct("athlete_id").alias("unique_athletes"))
    return counts.select("total_predictions", newest.scalar().alias("latest_score"), "unique_athletes")


def latest_run_figures(runs: DataFrame) -> DataFrame:
    """Version and test metrics of the newest run."""
    newest = runs.orderBy(F.desc("run_date"), F.desc("id")).limit(1)
    return with_run_metrics(newest).select("model_version", *RUN_METRICS)


def athlete_ids(df: DataFrame, first: int | None = None) -> DataFrame:
    """Distinct athlete ids in order; ``first`` keeps the head of the list."""
    ids = df.select(F.col("athlete_id").cast("string").alias("athlete_id"))
    ids = ids.filter(F.col("athlete_id").isNotNull()).distinct().orderBy("athlete_id")
    return ids if first is None else ids.limit(first)


def for_athletes(df: DataFrame, selected) -> DataFrame:
    """Rows of the selected athletes; an empty selection keeps all.

    A list becomes a filter the scan can use. A frame becomes a semi join whose
    strategy Spark picks from the measured size.
    """
    if isinstance(selected, DataFrame):
        if selected.isEmpty():
            return df
        # Repeats combine before the shuffle, however often one id is selected.
        wanted = selected.select(F.col("athlete_id").cast("string").alias("athlete_id")).distinct()
        return df.join(wanted, "athlete_id", "left_semi")
    return df.filter(F.col("athlete_id").isin(list(selected))) if selected else df


def history_figures(records: DataFrame) -> DataFrame:
    return records.agg(
        F.count(F.lit(1)).alias("records"),
        F.count_distinct("athlete_id").alias("athletes"),
        F.min("record_date").alias("first_date"),
        F.max("record_date").alias("last_date"),
    )


def daily_means(df: DataFrame, *values: str) -> DataFrame:
    """Mean of the label, and of further columns, per date over labelled rows."""
    return (
        df.filter(known(F.col(LABEL)))
        .groupBy("record_date")
        .agg(*[F.avg(c).alias(f"mean_{c}") for c in (LABEL, *values)])
        .orderBy("record_date")
    )


def series_in_order(df: DataFrame, time: str, *ties: str) -> DataFrame:
    return df.orderBy(time, *ties)


def melt(df: DataFrame, ids, values) -> DataFrame:
    """Long form of the value columns the frame has."""
    present = [c for c in values if c in df.columns]
    return df.unpivot(list(ids), present, "series", "value")


def preview(df: DataFrame, n: int, by: str, *ties: str) -> DataFrame:
    """The newest ``n`` rows."""
    return latest(df, n, by, *ties)


def lenient_timestamp(df: DataFrame, column: str) -> DataFrame:
    """Parses times where possible; what does not parse becomes NULL."""
    return df.withColumn(column, F.col(column).try_cast("timestamp"))
