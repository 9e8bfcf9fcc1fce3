"""Cleaning, feature and formatting expressions. All run inside the JVM."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from pacewell.settings import EPSILON


def known(c: Column) -> Column:
    """True where a double is neither NULL nor NaN.

    Written out rather than ``dropna`` because the NULL half of this
    condition reaches the Parquet scan as a pushed filter.
    """
    return c.isNotNull() & ~F.isnan(c)


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def any_of(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def names_where(conditions: dict[str, Column]) -> Column:
    """Array of the names whose condition holds.

    Joined from literal arrays, as ``array_compact`` would take the whole
    projection out of generated code. Rows without any skip the joining.
    """
    none = F.array().cast("array<string>")
    if not conditions:
        return none
    parts = [F.when(c, F.array(F.lit(n))).otherwise(none) for n, c in conditions.items()]
    return F.when(any_of(conditions.values()), F.concat(*parts)).otherwise(none)


def clip(c: Column, low: float, high: float) -> Column:
    """Limit to a closed range; a missing value stays missing.

    ``greatest``/``least`` skip NULL and would turn it into a bound.
    """
    return F.when(c < low, F.lit(low)).when(c > high, F.lit(high)).otherwise(c)


def sleep_recovery_ratio(hours: Column, quality: Column, recovery: Column) -> Column:
    return hours * quality / (recovery + F.lit(EPSILON))


def load_stress_ratio(load: Column, stress: Column) -> Column:
    return load / (stress + F.lit(EPSILON))


def default_if_missing(c: Column, value: float) -> Column:
    return F.coalesce(nan_to_null(c), F.lit(value))


def default_if_falsy(c: Column, value: float) -> Column:
    """A literal zero counts as missing, as the prediction request has it."""
    return F.when(c.isNull() | F.isnan(c) | (c == 0), F.lit(value)).otherwise(c)


def iso_text(ts: Column) -> Column:
    """ISO-8601 with six fraction digits; a missing time is empty text."""
    return F.coalesce(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit(""))


def shown(c: Column, digits: int = 3) -> Column:
    """Fixed-digit text for a panel, ``N/A`` when missing."""
    return F.coalesce(
        F.when(known(c), F.format_string(f"%.{digits}f", c)), F.lit("N/A")
    )


def band(c: Column, steps) -> Column:
    """Colour of the highest step not above the value; NULL gets none."""
    name = F.lit(None).cast("string")
    for start, colour in steps:
        reached = c.isNotNull() if start is None else c >= start
        name = F.when(reached, F.lit(colour)).otherwise(name)
    return name


def seconds(ts: Column) -> Column:
    """Epoch seconds of a timestamp with its fraction, for durations."""
    return F.unix_micros(ts.cast("timestamp")) / F.lit(1e6)


def seeded_hash(seed: int, key: Column) -> Column:
    """32 hex digits that depend on the seed and the key only."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key))


def leading_bits(hex_text: Column) -> Column:
    """First 60 bits of a hex digest as a non-negative long."""
    return F.conv(F.substring(hex_text, 1, 15), 16, 10).cast("long")


def row_key(columns) -> Column:
    """One text key over several columns; NULL differs from empty text."""
    return F.to_json(F.struct(*columns))
