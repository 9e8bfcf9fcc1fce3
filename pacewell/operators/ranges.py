"""Instant and range lookups on a grid of steps.

At each step a range vector holds the samples of a series in the width before
it, open at the start and closed at the end. Steps and widths are whole panes,
of as many seconds as divide both. Samples are ordered only inside a pane of
their series, and where just the last one is asked for not even there; a pane
is one row with its first and last sample, their number and the increase.

Panes and probes (the two ends of each step's range) then stand in one order,
and a probe takes the pane before or after it. A series is cut into slices no
narrower than the width; a slice gets its own panes and those of the slice
before, which is all that its steps can reach. A task orders two slices of
panes of a series, however long the series is.
"""

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MICROS = 1_000_000


def _probed(samples: DataFrame, keys, ts: str, value: str, step: int, width: int, ties, slice_seconds: int | None, ordered: bool = True) -> DataFrame:
    """(keys, at, n, total, first, last) of each step whose range holds samples; ``at``, in microseconds, ends the range.

    Without ``ordered`` only ``last`` is meant, and no sample is moved.
    """
    size = (slice_seconds or max(width, 64 * step)) * MICROS
    if size < width * MICROS or size % (step * MICROS):
        raise ValueError("a slice must be as wide as the range and hold whole steps")
    pane = math.gcd(step, width) * MICROS
    labels = {k: F.coalesce(k, F.lit("")) for k in keys if samples.schema[k].dataType.typeName() == "string"}
    known = samples.filter(F.col(value).isNotNull() & F.col(ts).isNotNull()).withColumns(labels)
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    own = known.select(*keys, us.alias("_us"), *[F.col(t).alias(f"_tie_{i}") for i, t in enumerate(ties)], F.col(value).alias("_v"))
    # A pane is open at the start: a sample on a step belongs to the range that ends there.
    own = own.withColumn("_pane", -F.floor(-F.col("_us") / pane))
    order = ["_us", *[f"_tie_{i}" for i in range(len(ties))], "_v"]
    sample = F.struct(F.col("_us").alias("us"), F.col("_v").alias("v"))

    def grown(before: Column, now: Column) -> Column:
        return F.when(before.isNull(), 0).when(now < before, now).otherwise(now - before)

    if ordered:
        inside = Window.partitionBy(*keys, "_pane").orderBy(*order)
        own = own.withColumn("_grown", grown(F.lag("_v").over(inside), F.col("_v")))
    else:
        own = own.withColumn("_grown", F.lit(0))
    panes = own.groupBy(*keys, "_pane").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_grown").alias("_inner"),
        F.min_by(sample, F.struct(*order)).alias("_first"), F.max_by(sample, F.struct(*order)).alias("_last"))
    # A pane is in the ranges that end in its slice of panes or in the next one.
    per = size // pane
    of = -F.floor(-F.col("_pane") / per)
    copies = panes.withColumn("_slice", F.explode(F.array(of, of + 1)))
    along = Window.partitionBy(*keys, "_slice").orderBy("_pane")
    bridge = grown(F.lag("_last.v").over(along), F.col("_first.v"))
    copies = copies.withColumn("_bridge", bridge).withColumn("_grown", F.col("_bridge") + F.col("_inner"))
    upto = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # Up to a pane's first sample, and up to its last one: what a range from one pane to another has grown by is their difference.
    so_far = copies.withColumns({"_count": F.sum("_n").over(upto), "_total": F.sum("_grown").over(upto)})
    taken = so_far.select(
        *keys, "_slice", "_pane", F.lit(0).alias("_kind"), F.lit(None).cast("long").alias("_at"),
        F.struct(F.col("_pane").alias("pane"), (F.col("_count") - F.col("_n")).alias("n"), F.col("_first").alias("at"),
                 (F.col("_total") - F.col("_inner")).alias("total")).alias("_head"),
        F.struct(F.col("_pane").alias("pane"), F.col("_count").alias("n"), F.col("_last").alias("at"), F.col("_total").alias("total")).alias("_tail"))
    ends = F.sequence((F.col("_slice") - 1) * size + step * MICROS, F.col("_slice") * size, F.lit(step * MICROS))
    steps = copies.select(*keys, "_slice").distinct().withColumn("_at", F.explode(ends))
    # Kind 1 stands behind the pane that ends with the range and takes the last one, kind 2 behind the pane before the range and takes the next one.
    nothing = {c: F.lit(None).cast(taken.schema[c].dataType).alias(c) for c in ("_head", "_tail")}
    probes = [steps.select(*keys, "_slice", F.floor((F.col("_at") - back * MICROS) / pane).alias("_pane"), F.lit(kind).alias("_kind"), "_at",
                           nothing["_head"], nothing["_tail"]) for kind, back in ((1, 0), (2, width))]
    line = Window.partitionBy(*keys, "_slice").orderBy("_pane", "_kind")
    found = taken.unionByName(probes[0]).unionByName(probes[1]).withColumns({
        "_tail": F.last("_tail", ignorenulls=True).over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "_head": F.first("_head", ignorenulls=True).over(line.rowsBetween(Window.currentRow, Window.unboundedFollowing))})
    both = found.filter("_kind > 0").groupBy(*keys, "_slice", F.col("_at").alias("at")).agg(
        F.max(F.when(F.col("_kind") == 2, F.col("_head"))).alias("head"), F.max(F.when(F.col("_kind") == 1, F.col("_tail"))).alias("tail"))
    return both.filter(F.col("head.pane") <= F.col("tail.pane")).select(
        *keys, "at", (F.col("tail.n") - F.col("head.n")).alias("n"), (F.col("tail.total") - F.col("head.total")).alias("total"),
        F.col("head.at").alias("first"), F.col("tail.at").alias("last"))


def _at(column: str = "at") -> Column:
    return F.timestamp_micros(column).alias("ts")


def range_increase(samples: DataFrame, keys, ts: str, value: str, step: int, width: int, ties=(),
                   slice_seconds: int | None = None) -> DataFrame:
    """(keys, ts, n_samples, increase, rate) of a counter over the ``width`` seconds before each step.

    Restarts count in full. The increase between the first and the last sample
    is carried on to the edges of the range: by half the mean distance of
    samples where an edge is farther off than 1.1 times that, else up to the
    edge, but never back beyond where the counter would have been 0. Ranges of
    fewer than two samples, or of samples at one time, have no result.
    """
    found = _probed(samples, keys, ts, value, step, width, ties, slice_seconds)
    n, raw = F.col("n"), F.col("total").cast("double")
    seconds = (F.col("last.us") - F.col("first.us")) / float(MICROS)
    rows = found.select(
        *keys, "at", n.alias("n_samples"), raw.alias("_raw"), seconds.alias("_span"), F.col("first.v").cast("double").alias("_v"),
        ((F.col("first.us") - F.col("at")) / float(MICROS) + width).alias("_head"), ((F.col("at") - F.col("last.us")) / float(MICROS)).alias("_tail"),
    ).filter("n_samples > 1 AND _span > 0")
    mean = F.col("_span") / (F.col("n_samples") - 1)

    def edge(gap: str) -> Column:
        return F.when(F.col(gap) >= mean * 1.1, mean / 2).otherwise(F.col(gap))

    to_zero = F.when((F.col("_raw") > 0) & (F.col("_v") >= 0), F.col("_span") * F.col("_v") / F.col("_raw"))
    head = F.when(to_zero < edge("_head"), to_zero).otherwise(edge("_head"))
    increase = F.col("_raw") * (F.col("_span") + head + edge("_tail")) / F.col("_span")
    return rows.select(*keys, _at(), "n_samples", increase.alias("increase"), (increase / float(width)).alias("rate"))


def last_within(samples: DataFrame, keys, ts: str, value: str, step: int, look_back: int, ties=(),
                slice_seconds: int | None = None) -> DataFrame:
    """(keys, ts, value): the last sample of each series at each step, if it is less than ``look_back`` seconds old."""
    found = _probed(samples, keys, ts, value, step, look_back, ties, slice_seconds, ordered=False)
    return found.select(*keys, _at(), F.col("last.v").alias("value"))


def services_up_at(samples: DataFrame, step: int = 15, look_back: int = 300, ts: str = "ts", ties=()) -> DataFrame:
    """(ts, services_up, n_known) at each step: jobs that are up, and jobs that said anything within ``look_back``.

    A job that has stopped sending counts neither way, as it is not known to be up.
    """
    known = last_within(samples, ["job"], ts, "up", step, look_back, ties)
    return known.groupBy("ts").agg(F.sum("value").cast("long").alias("services_up"), F.count(F.lit(1)).alias("n_known"))
