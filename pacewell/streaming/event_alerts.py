"""Alert states in event time: late samples are put in order on the state store.

Each series has its samples that the watermark has not passed yet, and the
state after the ones it has. A timer goes off when the watermark passes the
earliest waiting sample; what lies before the watermark is then taken in
order, so samples may arrive in any order within the bound for late ones. A
series that is silent for longer than a hold can bridge is forgotten.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from pacewell.operators.alerts import condition, described
from pacewell.settings import AlertRule

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_WAITING = T.StructType([T.StructField("ts", T.LongType()), T.StructField("on", T.BooleanType()), T.StructField("value", T.DoubleType())])
_HELD = T.StructType([T.StructField("last_ts", T.LongType()), T.StructField("on", T.BooleanType()), T.StructField("since", T.LongType())])
MILLION = 1_000_000


class HoldProcessor(StatefulProcessor):
    """Holds the state of one rule for each series; times are microseconds.

    ``hold`` and ``max_gap`` are as in ``timeline.hold_state``. With a
    ``max_gap``, a series without samples for longer than that leaves no trace:
    a hold could not go on over the gap anyway.
    """

    def __init__(self, keys: list[str], hold: int, max_gap: int | None):
        self.keys, self.hold, self.max_gap = keys, hold * MILLION, None if max_gap is None else max_gap * MILLION

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", _WAITING)
        self.held = handle.getValueState("held", _HELD)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        earliest = None
        for frame in rows:
            if frame.empty:
                continue
            new = list(zip(frame["at_us"].astype("int64").tolist(), frame["holds"].astype(bool).tolist(), frame["sample"].tolist()))
            self.waiting.appendList([(t, on, None if pd.isna(v) else float(v)) for t, on, v in new])
            first = min(t for t, _, _ in new)
            earliest = first if earliest is None else min(earliest, first)
        if earliest is not None:
            self._wake_at(earliest)
        return iter(())

    def _wake_at(self, us: int) -> None:
        self.handle.registerTimer(us // 1000 + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = sorted((tuple(r) for r in self.waiting.get()), key=lambda r: r[:2])  # of samples at one time, false ones come first
        ready = [r for r in waiting if r[0] <= passed]
        held = self.held.get()
        last_ts, was_on, since = held if held is not None else (None, False, None)
        out = []
        for ts, on, value in ready:
            linked = was_on and (self.max_gap is None or ts - last_ts <= self.max_gap)
            since = (since if linked else ts) if on else None
            state = "inactive" if not on else "firing" if ts - since >= self.hold else "pending"
            out.append((*key, ts, value, since, state))
            last_ts, was_on = ts, on
        if ready:
            rest = waiting[len(ready):]
            self.held.update((last_ts, was_on, since))
            if rest:
                self.waiting.put(rest)
                self._wake_at(rest[0][0])
            else:
                self.waiting.clear()
                if self.max_gap is not None:
                    self._wake_at(last_ts + self.max_gap + 1000)
        elif not waiting and held is not None and self.max_gap is not None and passed - last_ts > self.max_gap:
            self.held.clear()
        if out:
            yield pd.DataFrame(out, columns=[*self.keys, "at_us", "value", "since_us", "state"]).astype({"since_us": "Int64"})

    def close(self) -> None:
        pass


def event_time_alerts(values: DataFrame, rule: AlertRule, keys, late: str, ts: str = "ts", value: str = "value",
                      max_gap: int | None = None) -> DataFrame:
    """States of a rule for a stream of samples that may be late by up to ``late``.

    Gives what ``alerts.evaluate`` gives for all samples that are not later
    than that, each once the watermark has passed it. A null label is the empty
    one. Start the stream with ``with_state_store``.
    """
    keys = list(keys)
    instant = F.col(ts).cast("timestamp")
    rows = values.select(
        *[F.coalesce(F.col(k).cast("string"), F.lit("")).alias(k) for k in keys], instant.alias(ts),
        F.unix_micros(instant).alias("at_us"), F.coalesce(condition(rule, value), F.lit(False)).alias("holds"),
        F.col(value).cast("double").alias("sample")).withWatermark(ts, late)
    kind = ", ".join([*(f"`{k}` string" for k in keys), "at_us long, value double, since_us long, state string"])
    held = rows.groupBy(*keys).transformWithStateInPandas(
        HoldProcessor(keys, rule.hold, max_gap), kind, outputMode="Append", timeMode="EventTime")
    kept = F.col("value").cast(values.schema[value].dataType).alias("value")
    times = held.select(*keys, F.timestamp_micros("at_us").alias(ts), kept, F.timestamp_micros("since_us").alias("since"), "state")
    return described(times, rule, keys, ts)


def with_state_store(spark, start):
    """Runs ``start()`` with the state store that stateful processors need; streams of the session keep theirs."""
    before = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKS_DB)
    try:
        return start()
    finally:
        spark.conf.set(STATE_STORE, before)
