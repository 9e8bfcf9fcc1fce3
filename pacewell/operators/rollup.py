"""Daily partial aggregates that merge: counts, sums and sketches.

One row per day stands for all of its records. Rows of the same day from
different batches, and then days, are put together without looking at a record
again: counts and sums add up, HyperLogLog sketches unite into the number of
distinct athletes, KLL sketches merge into quantiles. Partials of partials are
partials again.

A distinct count is off by more than ``DISTINCT_ERROR`` of itself in about one
of 400 cases, a quantile's rank by more than ``RANK_ERROR`` of the number of
values in about one of 100; small sets are counted exactly.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacewell.functions.columns import known
from pacewell.schemas import LABEL, SENSORS

HLL_LOG_SIZE = 12
DISTINCT_ERROR = 0.05
KLL_SIZE = 400
RANK_ERROR = 0.01
SKETCHED = (*SENSORS, LABEL)


def daily_partials(records: DataFrame) -> DataFrame:
    """One row per day; records without a date share one. NULL and NaN are no values."""
    values = [F.kll_sketch_agg_double(F.when(known(F.col(c)), F.col(c)), KLL_SIZE).alias(f"{c}_sketch") for c in SKETCHED]
    label = F.when(known(F.col(LABEL)), F.col(LABEL))
    return records.groupBy("record_date").agg(
        F.count(F.lit(1)).alias("n_records"), F.count(label).alias("n_labelled"), F.sum(label).alias("label_sum"),
        F.hll_sketch_agg("athlete_id", HLL_LOG_SIZE).alias("athletes_sketch"), *values)


def _merged() -> list[Column]:
    return [
        F.sum("n_records").alias("n_records"), F.sum("n_labelled").alias("n_labelled"), F.sum("label_sum").alias("label_sum"),
        F.hll_union_agg("athletes_sketch").alias("athletes_sketch"),
        *[F.kll_merge_agg_double(f"{c}_sketch", KLL_SIZE).alias(f"{c}_sketch") for c in SKETCHED]]


def merge_partials(partials: DataFrame, *by) -> DataFrame:
    """Partials of the same day, or of the same ``by``, as one row."""
    return partials.groupBy(*(by or ["record_date"])).agg(*_merged())


def daily_means(partials: DataFrame) -> DataFrame:
    """As ``analytics.daily_means`` over the records."""
    sums = partials.groupBy("record_date").agg(F.sum("label_sum").alias("total"), F.sum("n_labelled").alias("n"))
    return sums.filter("n > 0").select("record_date", (F.col("total") / F.col("n")).alias(f"mean_{LABEL}")).orderBy("record_date")


def history_figures(partials: DataFrame, *by) -> DataFrame:
    """As ``analytics.history_figures`` over the records, athletes within ``DISTINCT_ERROR``."""
    return partials.groupBy(*by).agg(
        F.coalesce(F.sum("n_records"), F.lit(0)).alias("records"),
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("athletes_sketch")), F.lit(0)).alias("athletes"),
        F.min("record_date").alias("first_date"), F.max("record_date").alias("last_date"))


def quantiles(partials: DataFrame, column: str, phis: dict[str, float], *by) -> DataFrame:
    """Values near the given quantiles, by rank within ``RANK_ERROR``; NULL where there are no values."""
    if column not in SKETCHED:
        raise ValueError(f"no sketch of {column} is kept")
    merged = partials.groupBy(*by).agg(F.kll_merge_agg_double(f"{column}_sketch", KLL_SIZE).alias("sketch"))
    some = F.kll_sketch_get_n_double("sketch") > 0
    return merged.select(*by, *[
        F.when(some, F.kll_sketch_get_quantile_double("sketch", F.lit(float(phi)))).alias(name) for name, phi in phis.items()])
