"""Regression metrics."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacewell.schemas import LABEL


def mae(y: Column, p: Column) -> Column:
    return F.avg(F.abs(y - p))


def rmse(y: Column, p: Column) -> Column:
    return F.sqrt(F.avg((y - p) * (y - p)))


def r2(y: Column, p: Column) -> Column:
    """One pass: the total sum of squares is the merged population variance.

    NULL when the label does not vary.
    """
    total = F.var_pop(y) * F.count(y)
    return F.when(total > 0, F.lit(1.0) - F.sum((y - p) * (y - p)) / total)


def evaluate(scored: DataFrame, by=("split",), label: str = LABEL,
             prediction: str = "prediction") -> DataFrame:
    """``n_rows``, ``mae``, ``rmse`` and ``r2`` per group in one aggregate."""
    y, p = F.col(label), F.col(prediction)
    return scored.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        mae(y, p).alias("mae"),
        rmse(y, p).alias("rmse"),
        r2(y, p).alias("r2"),
    )


def long_form(metrics: DataFrame) -> DataFrame:
    """Rows ``(metric, value)`` named ``train_mae``, ``test_r2`` and so on."""
    long = metrics.unpivot(["split"], ["mae", "rmse", "r2"], "name", "value")
    return long.select(F.concat_ws("_", "split", "name").alias("metric"), "value")


def metric_map(rows) -> dict[str, float]:
    """The collected groups as one flat map; undefined metrics are left out."""
    return {f"{r['split']}_{m}": r[m] for r in rows for m in ("mae", "rmse", "r2")
            if r[m] is not None}
