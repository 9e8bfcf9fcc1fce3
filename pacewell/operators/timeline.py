"""Ordered computations per series, cut into time slices.

A window over a whole series would put all of its rows into one task. Here
rows are ordered only inside a time slice of their series. Each slice is
summarised in one row, the summaries are chained along the series, and what
a slice inherits from the ones before it is joined back. The rows one task
orders are then those of one slice, so the slice width sets the task size.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pacewell.functions.columns import seconds

SLICE = "_slice"


def _sliced(df: DataFrame, ts: str, width: int) -> DataFrame:
    return df.withColumn(SLICE, F.floor(seconds(F.col(ts)) / width))


def _labelled(df: DataFrame, keys) -> DataFrame:
    """An absent label is the empty label, so that keys compare with ``=``.

    Null-safe joins hash other expressions than the windows do and would
    shuffle the rows a second time.
    """
    texts = [k for k in keys if df.schema[k].dataType.typeName() == "string"]
    return df.withColumns({k: F.coalesce(k, F.lit("")) for k in texts})


def _inherit(rows: DataFrame, chained: DataFrame, keys, columns) -> DataFrame:
    """Adds the columns each slice inherits to its rows."""
    on = [*keys, SLICE]
    return rows.join(chained.select(*on, *columns), on, "left")


def running_number(df: DataFrame, keys, ts: str, ties=(), slice_seconds: int = 60,
                   name: str = "n") -> DataFrame:
    """Row number along each series, as ``row_number`` would give it."""
    rows = _sliced(_labelled(df, keys), ts, slice_seconds)
    inside = Window.partitionBy(*keys, SLICE).orderBy(ts, *ties)
    earlier = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(*keys, SLICE).agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    )
    numbered = rows.withColumn("_inside", F.row_number().over(inside))
    return (
        _inherit(numbered, offsets, keys, ["_before"])
        .withColumn(name, F.col("_inside") + F.col("_before"))
        .drop("_inside", "_before", SLICE)
    )


def counter_increase(samples: DataFrame, keys, ts: str, value: str, window_seconds: int,
                     ties=(), slice_seconds: int | None = None) -> DataFrame:
    """Increase and per-second rate of sampled counters per tumbling window.

    A sample below its predecessor means the counter restarted and counts in
    full. The first sample of a series counts nothing. A step between two
    samples belongs to the window of the later one; windows are not
    extrapolated to their edges.
    """
    width = slice_seconds or min(window_seconds, 60)
    if window_seconds % width:
        raise ValueError("slice_seconds must divide window_seconds")
    rows = _sliced(_labelled(samples, keys), ts, width)
    order = F.struct(ts, *ties, value)
    inside = Window.partitionBy(*keys, SLICE).orderBy(ts, *ties, value)

    def step(before, now):
        return F.when(now < before, now).otherwise(now - before)

    steps = rows.withColumn("_step", step(F.lag(value).over(inside), F.col(value)))
    slices = steps.groupBy(*keys, SLICE).agg(
        F.sum("_step").alias("_inner"),
        F.min_by(value, order).alias("_first"),
        F.max_by(value, order).alias("_last"),
    )
    along = Window.partitionBy(*keys).orderBy(SLICE)
    joined = slices.withColumn("_bridge", step(F.lag("_last").over(along), F.col("_first")))
    zero = F.lit(0).cast(samples.schema[value].dataType)
    start = (F.floor(F.col(SLICE) * width / window_seconds) * window_seconds).cast("long")
    return (
        joined.withColumn("window_start", F.timestamp_seconds(start))
        .groupBy(*keys, "window_start")
        .agg(F.sum(F.coalesce("_inner", zero) + F.coalesce("_bridge", zero)).alias("increase"))
        .withColumn("rate", F.col("increase") / F.lit(float(window_seconds)))
    )


def hold_state(samples: DataFrame, keys, ts: str, condition: Column, hold: int,
               max_gap: int | None = None, slice_seconds: int | None = None,
               carried: DataFrame | None = None) -> DataFrame:
    """Adds ``since`` and ``state`` (inactive, pending, firing) per sample.

    ``since`` is when the condition last became true; the state fires once it
    has held for ``hold`` seconds. A NULL condition counts as false, and a gap
    of more than ``max_gap`` seconds between samples breaks the hold. Of samples
    at one time, false ones come first.

    ``slice_seconds`` cuts long series into slices; leave it out where the
    samples are already one row per series and window. ``carried`` is the
    state at the end of earlier input (see ``closing_state``).
    """
    rows = _labelled(samples.withColumn("_on", F.coalesce(condition, F.lit(False))), keys)
    if slice_seconds is None:
        marked = _mark(rows, keys, ts, max_gap, carried)
    else:
        marked = _mark_sliced(rows, keys, ts, max_gap, slice_seconds, carried)
    held = seconds(F.col(ts)) - seconds(F.col("since"))
    state = (F.when(~F.col("_on"), "inactive")
             .when(held >= hold, "firing").otherwise("pending"))
    return marked.withColumn("state", state).drop("_on")


def _continues(on_before, ts_before, ts, max_gap) -> Column:
    """True if a true sample prolongs the hold of the sample before it."""
    linked = F.coalesce(on_before, F.lit(False))
    if max_gap is not None:
        linked = linked & (seconds(ts) - seconds(ts_before) <= max_gap)
    return linked


def _carried(rows, carried, keys) -> DataFrame:
    """Adds what the state before says of each series."""
    state = carried.select(*keys, F.col("last_ts").alias("_c_ts"),
                           F.col("last_on").alias("_c_on"), F.col("since").alias("_c_since"))
    return rows.join(state, list(keys), "left")


def _mark(rows, keys, ts, max_gap, carried) -> DataFrame:
    along = Window.partitionBy(*keys).orderBy(ts, "_on")
    on_before, ts_before, since_before = F.lag("_on").over(along), F.lag(ts).over(along), None
    if carried is not None:
        rows = _carried(rows, carried, keys)
        on_before = F.coalesce(on_before, F.col("_c_on"))
        ts_before = F.coalesce(ts_before, F.col("_c_ts"))
        since_before = F.col("_c_since")
    starts = F.col("_on") & ~_continues(on_before, ts_before, F.col(ts), max_gap)
    begun = rows.withColumn("_start", F.when(starts, F.col(ts)))
    since = F.last("_start", ignorenulls=True).over(
        along.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    if since_before is not None:
        since = F.coalesce(since, since_before)
    return begun.withColumn("since", F.when(F.col("_on"), since)).drop(
        "_start", "_c_ts", "_c_on", "_c_since")


def _mark_sliced(rows, keys, ts, max_gap, width, carried) -> DataFrame:
    rows = _sliced(rows, ts, width)
    inside = Window.partitionBy(*keys, SLICE).orderBy(ts, "_on")
    at = F.struct(ts, "_on")
    along = Window.partitionBy(*keys).orderBy(SLICE)
    on_before, ts_before = F.lag("_on").over(inside), F.lag(ts).over(inside)
    # The first row of a slice is judged below, against the slice before.
    starts = (F.col("_on") & ts_before.isNotNull()
              & ~_continues(on_before, ts_before, F.col(ts), max_gap))
    begun = rows.withColumn("_start", F.when(starts, F.col(ts)))
    slices = begun.groupBy(*keys, SLICE).agg(
        F.min(ts).alias("_first_ts"),
        F.max(ts).alias("_last_ts"),
        F.min_by("_on", at).alias("_first_on"),
        F.max_by("_on", at).alias("_last_on"),
        F.max("_start").alias("_inner"),
    )
    on_end, ts_end, since_end = F.lag("_last_on").over(along), F.lag("_last_ts").over(along), F.lit(None)
    if carried is not None:
        slices = _carried(slices, carried, keys)
        on_end, ts_end = F.coalesce(on_end, "_c_on"), F.coalesce(ts_end, "_c_ts")
        since_end = F.col("_c_since")
    linked = _continues(on_end, ts_end, F.col("_first_ts"), max_gap)
    opened = slices.withColumn("_head", F.when(F.col("_first_on") & ~linked, F.col("_first_ts")))
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    chained = opened.withColumn("_inherited", F.coalesce(
        "_head",
        F.last(F.coalesce("_inner", "_head"), ignorenulls=True).over(before),
        since_end,
    ))
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = begun.withColumn("_own", F.last("_start", ignorenulls=True).over(running))
    return (
        _inherit(marked, chained, keys, ["_inherited"])
        .withColumn("since", F.when(F.col("_on"), F.coalesce("_own", "_inherited")))
        .drop("_start", "_own", "_inherited", SLICE)
    )


def closing_state(held: DataFrame, keys, ts: str) -> DataFrame:
    """The last sample of each series, to carry into the next batch."""
    on = F.col("state") != "inactive"
    last = F.max_by(F.struct(F.col(ts).alias("last_ts"), on.alias("last_on"), F.col("since").alias("since")),
                    F.struct(F.col(ts), on))
    return held.groupBy(*keys).agg(last.alias("_last")).select(*keys, "_last.*")
