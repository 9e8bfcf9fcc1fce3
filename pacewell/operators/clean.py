"""Dropping incomplete records and clipping measurements."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pacewell.functions.columns import clip, known, nan_to_null
from pacewell.schemas import CRITICAL, SENSORS
from pacewell.settings import CLIP_BOUNDS


def drop_incomplete(df: DataFrame, columns=CRITICAL) -> DataFrame:
    """Keeps rows in which every given column has a value."""
    return df.filter(reduce(lambda a, b: a & b, [known(F.col(c)) for c in columns]))


def clip_critical(df: DataFrame, bounds=CLIP_BOUNDS) -> DataFrame:
    return df.withColumns({c: clip(F.col(c), *bounds[c]) for c in CRITICAL})


def clip_sensors(df: DataFrame, bounds=CLIP_BOUNDS) -> DataFrame:
    """Clips the optional sensors the frame has; a missing reading stays NULL."""
    present = [c for c in SENSORS if c in df.columns]
    return df.withColumns({c: clip(nan_to_null(F.col(c)), *bounds[c]) for c in present})


def clean(df: DataFrame) -> DataFrame:
    return clip_sensors(clip_critical(drop_incomplete(df)))
