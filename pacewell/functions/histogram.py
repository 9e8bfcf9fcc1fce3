"""Latency histograms: cumulative bucket counts and interpolated quantiles."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def bucket_columns(bounds) -> list[str]:
    return [f"le_{i}" for i in range(len(bounds))] + ["le_inf"]


def cumulative_counts(value: Column, bounds) -> list[Column]:
    """One conditional count per bound plus the total.

    They share a single hash aggregate: no row is multiplied by the bounds,
    and the partial counts combine before the shuffle.
    """
    counts = [
        F.count(F.when(value <= F.lit(float(b)), F.lit(1))).alias(name)
        for b, name in zip(bounds, bucket_columns(bounds))
    ]
    return counts + [F.count(value).alias("le_inf")]


def quantile(phi: float, bounds, counts: list[Column]) -> Column:
    """Linear interpolation inside the bucket that holds rank ``phi * total``.

    ``counts`` are cumulative, the last one being the total. The first bucket
    starts at zero; a rank in the +Inf bucket gives the last finite bound; an
    empty histogram gives NULL.
    """
    if not 0 < phi <= 1:
        raise ValueError("phi must be in (0, 1]")
    total = counts[-1]
    rank = F.lit(float(phi)) * total
    result = F.when(total == 0, F.lit(None).cast("double"))
    lower, below = 0.0, F.lit(0)
    for bound, count in zip(bounds, counts):
        inside = F.nullif(count - below, F.lit(0))
        result = result.when(
            count >= rank,
            F.lit(lower) + F.lit(float(bound) - lower) * ((rank - below) / inside),
        )
        lower, below = float(bound), count
    return result.otherwise(F.lit(lower))
