"""Alert rules over series of values."""

import operator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacewell.operators.observability import error_ratio, latency_quantiles, matching
from pacewell.operators.timeline import hold_state
from pacewell.settings import HIGH_ERROR_RATE, HIGH_LATENCY, SERVICE_DOWN, SERVICES, AlertRule

_COMPARE = {"==": operator.eq, "!=": operator.ne, ">": operator.gt, ">=": operator.ge,
            "<": operator.lt, "<=": operator.le}


def _filled(template: str, keys):
    """The text with each ``{label}`` replaced by that row's value."""
    text = F.lit(template)
    for k in keys:
        text = F.replace(text, F.lit("{" + k + "}"), F.col(k))
    return text


def condition(rule: AlertRule, value: str = "value"):
    """What a rule asks of a value."""
    return _COMPARE[rule.compare](F.col(value), F.lit(rule.threshold))


def described(held: DataFrame, rule: AlertRule, keys=(), ts: str = "ts") -> DataFrame:
    """States with the rule's name, severity and texts."""
    return held.select(
        F.lit(rule.name).alias("alert"), *keys, ts, "value", "since", "state",
        F.lit(rule.severity).alias("severity"),
        _filled(rule.summary, keys).alias("summary"),
        _filled(rule.description, keys).alias("description"),
    )


def evaluate(values: DataFrame, rule: AlertRule, keys=(), ts: str = "ts", value: str = "value",
             max_gap: int | None = None, slice_seconds: int | None = None,
             carried: DataFrame | None = None) -> DataFrame:
    """State of one rule at every sample of every series."""
    named = values.withColumn("alert", F.lit(rule.name))
    held = hold_state(named, ["alert", *keys], ts, condition(rule, value), rule.hold, max_gap, slice_seconds, carried)
    return described(held.withColumn("value", F.col(value)), rule, keys, ts)


def service_down(samples: DataFrame, rule: AlertRule = SERVICE_DOWN,
                 slice_seconds: int | None = 3600) -> DataFrame:
    """Raw samples can be many per job, so the series are cut into slices."""
    known = matching(samples, patterns={"job": "|".join(SERVICES)})
    return evaluate(known, rule, ["job"], value="up", slice_seconds=slice_seconds)


def high_latency(log: DataFrame, rule: AlertRule = HIGH_LATENCY, width: int = 300,
                 job: str = "api") -> DataFrame:
    """A window without requests has no quantile and ends the hold."""
    p95 = latency_quantiles(matching(log, {"job": job}), (), width, {"value": 0.95})
    return evaluate(p95, rule, ts="window_start", max_gap=width)


def high_error_rate(log: DataFrame, rule: AlertRule = HIGH_ERROR_RATE, width: int = 300,
                    job: str = "api") -> DataFrame:
    ratio = error_ratio(matching(log, {"job": job}), (), width)
    return evaluate(ratio, rule, ts="window_start", max_gap=width)
