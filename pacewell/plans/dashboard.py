"""The dashboard pages as frames.

A page describes the whole table, or its newest ``limit`` rows where a limit is
given. Previews find the newest days with a count when the page is made; apart
from that the frames are lazy.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from pacewell.functions.columns import shown
from pacewell.operators import analytics
from pacewell.schemas import LABEL


@dataclass(frozen=True)
class Page:
    figures: DataFrame
    series: DataFrame
    preview: DataFrame


def _newest(df: DataFrame, limit: int | None, time: str, *ties: str) -> DataFrame:
    """The page's rows: a limited page is cached, as all of its parts read it."""
    if limit is None:
        return df
    return analytics.latest(df, limit, time, *ties).persist(StorageLevel.MEMORY_AND_DISK)


def predictions_page(predictions: DataFrame, limit: int | None = None) -> Page:
    rows = _newest(predictions, limit, "created_at", "id")
    series = analytics.melt(rows.select("id", "created_at", LABEL), ["id", "created_at"], [LABEL])
    return Page(
        analytics.prediction_figures(rows),
        analytics.series_in_order(series, "created_at", "id"),
        analytics.preview(rows, 180, "created_at", "id"),
    )


def training_page(runs: DataFrame, limit: int | None = None) -> Page:
    rows = analytics.with_run_metrics(_newest(runs, limit, "run_date", "id"))
    newest = rows.orderBy(F.desc("run_date"), F.desc("id")).limit(1)
    series = analytics.melt(rows, ["id", "run_date"], analytics.RUN_METRICS)
    return Page(
        newest.select(F.coalesce("model_version", F.lit("N/A")).alias("model_version"),
                      *[shown(F.col(m)).alias(m) for m in analytics.RUN_METRICS]),
        analytics.series_in_order(series, "run_date", "id", "series"),
        analytics.preview(rows, 120, "run_date", "id"),
    )


def history_page(records: DataFrame, limit: int | None = None, athletes=None,
                 ties=("athlete_id",)) -> Page:
    """``athletes=None`` selects the first five ids, an empty list all rows.

    The five ids are fetched: as a list they become a filter of the scan.
    """
    rows = _newest(records, limit, "record_date", *ties)
    if athletes is None:
        athletes = [r["athlete_id"] for r in analytics.athlete_ids(rows, 5).collect()]
    selected = analytics.for_athletes(rows, athletes)
    means = analytics.daily_means(selected).withColumnRenamed(f"mean_{LABEL}", LABEL)
    return Page(
        analytics.history_figures(selected),
        analytics.melt(means, ["record_date"], [LABEL]),
        analytics.preview(selected, 240, "record_date", *ties),
    )
