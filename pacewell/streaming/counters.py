"""Increases of sampled counters over a stream.

A pane is a short stretch of one series. Its samples are held until the
watermark has passed it, so that late ones find their place, and are then
summed up as first value, last value and increase with restarts. Panes of a
series follow each other in time from then on: what lies between two of them
is the step from the last value to the first. All of that adds up, so each
micro-batch writes what it adds to each window, and a window is the sum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from pacewell.streaming.jobs import CAUGHT_UP, batch_path, carried_state, slot_path, watermarked


def _step(before: Column, now: Column) -> Column:
    """A sample below its predecessor means that the counter restarted and counts in full."""
    return F.when(now < before, now).otherwise(now - before)


def counter_panes(samples: DataFrame, keys, late: str, value: str = "v", ts: str = "ts", ties=(), pane: int = 60) -> DataFrame:
    """(keys, pane_start, first, last, inner) of every pane that the watermark has passed.

    Samples later than ``late`` and samples without a value are left out; of
    samples at one time, ``ties`` and then the value decide the order. A null
    label is the empty one. The state holds the samples of open panes only.
    """
    known = samples.filter(F.col(value).isNotNull()).withColumns(
        {k: F.coalesce(k, F.lit("")) for k in keys if samples.schema[k].dataType.typeName() == "string"})
    sample = F.struct(F.col(ts).alias("at"), *[F.col(t).alias(f"tie_{i}") for i, t in enumerate(ties)], F.col(value).alias("value"))
    held = watermarked(known, late, ts).groupBy(F.window(ts, f"{pane} seconds").alias("w"), *keys).agg(
        F.sort_array(F.collect_list(sample)).alias("run"))
    values = held.select(*keys, F.col("w.start").alias("pane_start"), F.col("run.value").alias("run"))
    steps = F.zip_with(F.slice("run", 1, F.size("run") - 1), F.slice("run", 2, F.size("run") - 1), _step)
    nothing = F.lit(0).cast(samples.schema[value].dataType)
    return values.select(
        *keys, "pane_start", F.element_at("run", 1).alias("first"), F.element_at("run", -1).alias("last"),
        F.aggregate(steps, nothing, lambda total, step: total + step).alias("inner"))


def counter_increase_stream(panes: DataFrame, keys, window_seconds: int, path: str, state_path: str,
                            checkpoint: str, trigger=None):
    """Writes, for each micro-batch of panes, what it adds to the windows of each series.

    The state is the last value of each series, in slots as for alerts; a
    repeated batch reads and writes the same ones.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        carried = carried_state(batch.sparkSession, state_path, batch_id)
        panes = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            along = Window.partitionBy(*keys).orderBy("pane_start")
            before = F.lag("last").over(along)
            rows = panes
            if carried is not None:
                rows = panes.join(carried.select(*keys, F.col("last").alias("_carried")), list(keys), "left")
                before = F.coalesce(before, F.col("_carried"))
            start = F.floor(F.unix_seconds("pane_start") / window_seconds) * window_seconds
            bridged = rows.withColumn("_bridge", _step(before, F.col("first"))).select(
                *keys, F.timestamp_seconds(start).alias("window_start"),
                (F.col("inner") + F.coalesce("_bridge", F.lit(0))).alias("increase"))
            added = bridged.groupBy(*keys, "window_start").agg(F.sum("increase").alias("increase"))
            added.write.mode("overwrite").parquet(batch_path(path, batch_id))
            state = panes.groupBy(*keys).agg(F.max_by("last", "pane_start").alias("last"))
            if carried is not None:
                state = state.unionByName(carried.join(state.select(*keys), list(keys), "left_anti"))
            state.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").parquet(slot_path(state_path, batch_id))
        finally:
            panes.unpersist()

    return (panes.writeStream.outputMode("append").foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or CAUGHT_UP)).start())


def read_counter_increase(spark: SparkSession, path: str, keys, window_seconds: int) -> DataFrame:
    """Increase and rate of each window so far; the last window of a series may still grow."""
    added = spark.read.parquet(path).groupBy(*keys, "window_start").agg(F.sum("increase").alias("increase"))
    return added.withColumn("rate", F.col("increase") / F.lit(float(window_seconds)))
