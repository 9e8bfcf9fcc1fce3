"""Validation profiles as column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from pacewell.functions.columns import any_of, names_where
from pacewell.settings import Length, Present, Range


def rule_conditions(profile) -> dict[str, Column]:
    """Rule name to a never-NULL condition that is true on a violation."""
    out = {}
    for rule in profile:
        c = F.col(rule.field)
        if isinstance(rule, Range):
            outside = F.lit(False)
            if rule.low is not None:
                outside = outside | (c < float(rule.low))
            if rule.high is not None:
                outside = outside | (c > float(rule.high))
            # NaN sorts above every number, so an open top needs its own test.
            outside = outside | F.isnan(c)
            out[f"{rule.field}_range"] = F.coalesce(outside, F.lit(False))
            if rule.required:
                out[f"{rule.field}_missing"] = c.isNull()
        elif isinstance(rule, Length):
            size = F.char_length(c)
            out[f"{rule.field}_length"] = c.isNull() | (size < rule.low) | (size > rule.high)
        elif isinstance(rule, Present):
            out[f"{rule.field}_missing"] = c.isNull()
        else:
            raise TypeError(f"unknown rule {rule!r}")
    return out


def violations(profile) -> Column:
    """Names of the violated rules of a row, in profile order."""
    return names_where(rule_conditions(profile))


def broken(profile) -> Column:
    """True if the row violates any rule."""
    return any_of(rule_conditions(profile).values())
