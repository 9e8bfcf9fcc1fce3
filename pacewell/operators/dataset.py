"""Labelled rows and reproducible train/test splits."""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pacewell.errors import InsufficientDataError
from pacewell.functions.columns import known, leading_bits, row_key, seeded_hash
from pacewell.operators.order_stats import select_ranks
from pacewell.schemas import LABEL
from pacewell.settings import MIN_LABELLED_ROWS, SEED, TEST_SIZE

TRAIN, TEST = "train", "test"


def labelled(df: DataFrame) -> DataFrame:
    return df.filter(known(F.col(LABEL)))


def require_labelled(df: DataFrame, minimum: int = MIN_LABELLED_ROWS) -> DataFrame:
    """Fails below the minimum; stops counting as soon as it is reached."""
    found = df.limit(minimum).count()
    if found < minimum:
        raise InsufficientDataError(minimum, found)
    return df


def _key(df: DataFrame, key_columns) -> Column:
    columns = list(key_columns or df.columns)
    if len(columns) == 1:
        return F.col(columns[0]).cast("string")
    return row_key([F.col(c) for c in columns])


def hash_split(df: DataFrame, key_columns=None, test_size: float = TEST_SIZE,
               seed: int = SEED) -> DataFrame:
    """Adds ``split`` from a keyed hash.

    A projection: no shuffle, and a row keeps its side however the data is
    partitioned or recomputed. The test share is ``test_size`` in expectation.
    """
    if not 0 < test_size < 1:
        raise ValueError("test_size must be between 0 and 1")
    threshold = f"{int(test_size * 2**32):08x}"
    digest = F.substring(seeded_hash(seed, _key(df, key_columns)), 1, 8)
    return df.withColumn("split", F.when(digest < threshold, TEST).otherwise(TRAIN))


def exact_split(df: DataFrame, key_columns=None, test_size: float = TEST_SIZE,
                seed: int = SEED) -> DataFrame:
    """Adds ``split`` with exactly ``ceil(test_size * n)`` test rows.

    Rows rank by keyed hash. Finding the hash at the wanted rank takes a few
    counting passes; the split itself is then a comparison, not a sort.
    """
    if not 0 < test_size < 1:
        raise ValueError("test_size must be between 0 and 1")
    first = leading_bits(seeded_hash(seed, _key(df, key_columns)))
    top = 2**60 - 1
    cut = select_ranks(df, {"hash": (first, "long", 0, top)},
                       lambda n: [math.ceil(test_size * n) - 1], scanned=False)["hash"]
    if not cut:
        return df.withColumn("split", F.lit(TRAIN))
    edge = cut[0]
    wanted = math.ceil(test_size * edge.total)
    side = _side(first, edge, wanted)
    if side is not None:
        return df.withColumn("split", side)

    # Several rows share the hash at the cut: rank those by their whole content.
    second = leading_bits(seeded_hash(seed, row_key([F.col(c) for c in df.columns])))
    tied = df.filter(first == edge.value)
    needed = wanted - edge.below
    inner = select_ranks(tied, {"hash": (second, "long", 0, top)}, lambda n: [needed - 1], scanned=False)["hash"][0]
    side = _side(second, inner, needed)
    if side is not None:
        return df.withColumn(
            "split", F.when(first < edge.value, TEST).when(first > edge.value, TRAIN).otherwise(side))

    # What is left at the cut are copies of one row: any of them may be test.
    at_cut = (first == edge.value) & (second == inner.value)
    before = (first < edge.value) | ((first == edge.value) & (second < inner.value))
    rest = df.filter(~at_cut).withColumn("split", F.when(before, TEST).otherwise(TRAIN))
    row = tied.filter(second == inner.value).take(1)[0]
    copies = df.sparkSession.range(inner.equal).select(
        *[F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in df.schema.fields],
        F.when(F.col("id") < needed - inner.below, TEST).otherwise(TRAIN).alias("split"))
    return rest.unionByName(copies)


def _side(value: Column, edge, wanted: int) -> Column | None:
    """Test/train by comparison, if the cut does not divide equal values."""
    if wanted == edge.below + edge.equal:
        return F.when(value <= edge.value, TEST).otherwise(TRAIN)
    return None


def sample_counts(split: DataFrame) -> DataFrame:
    return split.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))
