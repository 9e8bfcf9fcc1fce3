"""Service metrics from a request log: rates, latency quantiles, ratios.

Everything is built from additive counts per key and window, so partial
counts combine before the shuffle and a busy endpoint is never gathered in
one task. Sliding windows are rolled up from panes of counts, not from rows.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacewell.functions.histogram import bucket_columns, cumulative_counts, quantile
from pacewell.settings import LATENCY_BOUNDS, UNMEASURED_PATHS


def measured(log: DataFrame, skipped=UNMEASURED_PATHS) -> DataFrame:
    """Requests that count; probe and metrics paths do not."""
    for prefix in skipped:
        log = log.filter(~F.col("endpoint").startswith(prefix))
    return log


def matching(df: DataFrame, equals: dict[str, str] | None = None,
             patterns: dict[str, str] | None = None) -> DataFrame:
    """Label matchers: equality, and patterns that must cover the whole value."""
    for name, value in (equals or {}).items():
        df = df.filter(F.col(name) == value)
    for name, pattern in (patterns or {}).items():
        df = df.filter(fully_matches(F.col(name), pattern))
    return df


def fully_matches(c: Column, pattern: str) -> Column:
    return c.rlike(rf"\A(?:{pattern})\z")


def windowed(log: DataFrame, keys, width: int, counts: list[Column],
             slide: int | None = None, ts: str = "ts") -> DataFrame:
    """Additive aggregates per key and window of ``width`` seconds.

    With ``slide`` the windows overlap: rows are counted once into panes of
    ``slide`` seconds and the few pane rows are spread over their windows.
    """
    pane = slide or width
    if width % pane:
        raise ValueError("slide must divide width")
    start = F.window(ts, f"{pane} seconds").start.alias("window_start")
    panes = log.groupBy(start, *keys).agg(*counts)
    if pane == width:
        return panes
    names = [c for c in panes.columns if c not in (*keys, "window_start")]
    first = F.col("window_start") - F.expr(f"INTERVAL '{width - pane}' SECOND")
    starts = F.sequence(first, F.col("window_start"), F.expr(f"INTERVAL '{pane}' SECOND"))
    return (
        panes.withColumn("window_start", F.explode(starts))
        .groupBy(*keys, "window_start")
        .agg(*[F.sum(n).alias(n) for n in names])
    )


def request_rate(log: DataFrame, keys=(), width: int = 300, slide: int | None = None,
                 scale: float = 1.0) -> DataFrame:
    """Requests per second, times ``scale``, per key and window."""
    counted = windowed(log, keys, width, [F.count(F.lit(1)).alias("n_requests")], slide)
    return counted.select(*keys, "window_start",
                          (F.col("n_requests") / F.lit(float(width)) * scale).alias("rate"))


def request_increase(log: DataFrame, keys=(), width: int = 3600,
                     slide: int | None = None) -> DataFrame:
    """Requests per key and window."""
    return windowed(log, keys, width, [F.count(F.lit(1)).alias("increase")], slide)


def error_counts(log: DataFrame, keys=(), width: int = 300, slide: int | None = None,
                 error_pattern: str = "5..") -> DataFrame:
    failed = F.when(fully_matches(F.col("status"), error_pattern), F.lit(1))
    return windowed(log, keys, width,
                    [F.count(failed).alias("n_errors"), F.count(F.lit(1)).alias("n_requests")], slide)


def success_ratio(log: DataFrame, keys=(), width: int = 300, slide: int | None = None) -> DataFrame:
    """One minus the share of 5xx answers; 1.0 where none failed."""
    counted = error_counts(log, keys, width, slide)
    return counted.select(*keys, "window_start",
                          (F.lit(1.0) - F.col("n_errors") / F.col("n_requests")).alias("success_ratio"))


def error_ratio(log: DataFrame, keys=(), width: int = 300, slide: int | None = None) -> DataFrame:
    counted = error_counts(log, keys, width, slide)
    return counted.select(*keys, "window_start",
                          (F.col("n_errors") / F.col("n_requests")).alias("value"))


def latency_histogram(log: DataFrame, keys=(), width: int | None = None,
                      bounds=LATENCY_BOUNDS, slide: int | None = None) -> DataFrame:
    """Cumulative bucket counts, one column per bound, per key (and window)."""
    counts = cumulative_counts(F.col("duration"), bounds)
    if width is None:
        return log.groupBy(*keys).agg(*counts)
    return windowed(log, keys, width, counts, slide)


def histogram_rows(histogram: DataFrame, keys, bounds=LATENCY_BOUNDS) -> DataFrame:
    """One row per bucket with its upper bound ``le`` as text."""
    names = bucket_columns(bounds)
    labels = dict(zip(names, [str(float(b)) for b in bounds] + ["+Inf"]))
    wide = histogram.select(*keys, *[F.col(n).alias(labels[n]) for n in names])
    return wide.unpivot(list(keys), [F.col(f"`{v}`") for v in labels.values()], "le", "n_requests")


def latency_quantiles(log: DataFrame, keys=(), width: int | None = 300,
                      phis: dict[str, float] | None = None, bounds=LATENCY_BOUNDS,
                      slide: int | None = None) -> DataFrame:
    """Interpolated quantiles per key and window from one histogram."""
    phis = phis or {"p50": 0.5, "p95": 0.95}
    histogram = latency_histogram(log, keys, width, bounds, slide)
    counts = [F.col(n) for n in bucket_columns(bounds)]
    by = [*keys] if width is None else [*keys, "window_start"]
    return histogram.select(*by, *[quantile(p, bounds, counts).alias(n) for n, p in phis.items()])


def quantiles_of_buckets(increases: DataFrame, keys=(), phis: dict[str, float] | None = None,
                         bounds=LATENCY_BOUNDS, value: str = "increase") -> DataFrame:
    """Quantiles from bucket counters: ``le`` rows summed over other labels.

    ``increases`` has one row per series, bucket and window, as
    ``counter_increase`` gives them. Bounds are matched as numbers.
    """
    phis = phis or {"p50": 0.5, "p95": 0.95}
    bound = F.col("le").try_cast("double")
    names = bucket_columns(bounds)
    sums = [F.sum(F.when(bound == F.lit(float(b)), F.col(value))).alias(n)
            for b, n in zip(bounds, names)]
    sums.append(F.sum(F.when(F.col("le") == "+Inf", F.col(value))).alias(names[-1]))
    wide = increases.groupBy(*keys, "window_start").agg(*sums)
    counts = [F.coalesce(n, F.lit(0)) for n in names]
    return wide.select(*keys, "window_start",
                       *[quantile(p, bounds, counts).alias(n) for n, p in phis.items()])


def last_known(df: DataFrame, keys, value: str, ts: str, *ties: str) -> DataFrame:
    """Newest value that is not NULL, per series."""
    # A plain sort key keeps the aggregate hash-based; a struct makes it sort.
    order = F.struct(ts, *ties) if ties else F.col(ts)
    return df.filter(F.col(value).isNotNull()).groupBy(*keys).agg(F.max_by(value, order).alias(value))


def services_up(samples: DataFrame, pattern: str) -> DataFrame:
    """Sum of each matching job's newest ``up`` sample."""
    newest = last_known(matching(samples, patterns={"job": pattern}), ["job"], "up", "ts")
    return newest.agg(F.sum("up").alias("services_up"))


def time_grid(df: DataFrame, ts: str, step: int, labels: dict[str, list[str]],
              block: int = 1000) -> DataFrame:
    """A row per step between first and last row, for every label value.

    Fills silent periods: a left join from the grid has rows where the data
    has none. Its size depends on the time range, not on the rows. Blocks of
    steps are spread over the partitions before they are expanded.
    """

    def position(c):
        return F.floor(F.unix_seconds(c.cast("timestamp")) / step).cast("long")

    ends = df.agg(position(F.min(ts)).alias("lo"), position(F.max(ts)).alias("hi"))
    blocks = ends.select("hi", F.explode(F.sequence("lo", "hi", F.lit(block))).alias("first"))
    steps = F.sequence("first", F.least(F.col("hi"), F.col("first") + (block - 1)))
    grid = (
        blocks.repartition("first")
        .select(F.explode(steps).alias("n"))
        .select(F.timestamp_seconds(F.col("n") * step).alias(ts))
    )
    for name, values in labels.items():
        grid = grid.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))
    return grid


def up_samples(log: DataFrame, step: int, jobs) -> DataFrame:
    """``up`` is 1 where the job logged anything during the step, else 0."""
    seen = windowed(log, ["job"], step, [F.count(F.lit(1)).alias("n")])
    seen = seen.select(F.col("window_start").cast("timestamp").alias("ts"), "job", "n")
    grid = time_grid(log, "ts", step, {"job": list(jobs)})
    return grid.join(seen, ["ts", "job"], "left").select(
        "ts", "job", F.when(F.col("n") > 0, 1).otherwise(0).alias("up"))
