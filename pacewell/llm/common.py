"""Reading the tables, scratch tables and the crc32 folds that queries share."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pacewell.session import importable, scratch_path

TOKENIZER = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Where the public vocabulary files lie on this machine; every executor has them installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written once to the shared folder and read back, which cuts its lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(key: Column, n: int) -> Column:
    """crc32 of the key's text modulo ``n``; a null key falls in no fold."""
    return F.crc32(key.cast("string").cast("binary")) % n


def record_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
