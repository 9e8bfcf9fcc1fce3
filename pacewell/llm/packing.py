"""Harmonic packing of token pieces into sequences.

A document's ids are cut into whole sequences, then into falling powers of two
down to a grid, then one short tail. A piece of length l belongs to the class
k = capacity // l, whose bins take any k pieces. Each task numbers its pieces
of a class by itself; a small table of counts per task and class shifts those
numbers, so bins are filled independently and no rows are gathered. What is
left over from incomplete bins (fewer than k pieces a class, a number bounded
by the capacity and not by the data) is packed first-fit decreasing.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from pacewell.llm import common, encoding

CAPACITY = 2048
GRID = 32
END_ID = 1

PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()),
    T.StructField("doc_tokens", T.LongType()),
    T.StructField("klass", T.IntegerType()),
    T.StructField("task", T.IntegerType()),
    T.StructField("number", T.LongType()),
])


def cut_lengths(total: int, capacity: int = CAPACITY, grid: int = GRID) -> list[int]:
    """Lengths of the pieces of ``total`` ids: whole sequences, powers of two, and a tail below the grid."""
    lengths = [capacity] * (total // capacity)
    rest, size = total % capacity, capacity // 2
    while size >= grid and rest:
        if rest >= size:
            lengths.append(size)
            rest -= size
        size //= 2
    if rest:
        lengths.append(rest)
    return lengths


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, grid: int = GRID, end_id: int = END_ID) -> DataFrame:
    """Pieces of the encoded texts, numbered per task and class.

    A null or empty text is its end id alone; a null doc_id stays null; repeated
    rows are documents of their own; other columns are not read. An empty table
    gives no rows.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([pa.field(f.name, pa.int32() if f.dataType == T.IntegerType() else pa.int64()) for f in PIECES])
        task, numbers = TaskContext.get().partitionId(), {}
        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            for first, ids, bounds in encoding.encoder(path).encode(batch.column("text")):
                rows = []
                for row, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist()), first):
                    own = np.append(ids[a:b], np.uint32(end_id)).astype("<u4").tobytes()
                    total, start = b - a + 1, 0
                    for length in cut_lengths(total, capacity, grid):
                        klass = capacity // length
                        number = numbers.get(klass, 0)
                        numbers[klass] = number + 1
                        crc = zlib.crc32(own[4 * start : 4 * (start + length)])
                        rows.append((doc_ids[row], start, length, crc, total, klass, task, number))
                        start += length
                yield common.record_batch(schema, *zip(*rows))

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(cut, PIECES)


def _first_fit(capacity: int):
    def place(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending")])
        free, bins, offsets = [], [], []
        lowest = 0  # bins before this one have no room for pieces of this length or longer
        last = None
        for length in rows["length"].to_pylist():
            if length != last:
                lowest, last = 0, length
            while lowest < len(free) and free[lowest] < length:
                lowest += 1
            if lowest == len(free):
                free.append(capacity)
            bins.append(lowest)
            offsets.append(capacity - free[lowest])
            free[lowest] -= length
        columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
        return rows.select(columns).append_column("bin", pa.array(bins, pa.int64())).append_column("offset", pa.array(offsets, pa.int64()))

    return place


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces that carry (length, klass, task, number).

    Pieces may have any lengths from 1 to the capacity. Bins of class k hold
    exactly k pieces; their offsets have no gaps.
    """
    pieces = common.stored(pieces, "pieces")
    counts = pieces.groupBy("klass", "task").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("klass").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    counts = common.stored(counts.select("klass", "task", "n", F.coalesce(before, F.lit(0)).alias("before")), "piece-counts")
    # One row per class: at most 2 * sqrt(capacity) of them.
    totals = {r["klass"]: r["total"] for r in counts.groupBy("klass").agg(F.sum("n").alias("total")).collect()}
    base, used = {}, 0
    for klass in sorted(totals):
        base[klass] = used
        used += totals[klass] // klass
    numbered = pieces.join(counts.select("klass", "task", "before"), ["klass", "task"]).withColumn("at", F.col("before") + F.col("number"))
    full = F.create_map(*[F.lit(x) for k in totals for x in (k, totals[k] // k * k)]) if totals else None
    bases = F.create_map(*[F.lit(x) for k in totals for x in (k, base[k])]) if totals else None
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    if full is None:
        return numbered.select(*columns, F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    complete = F.col("at") < full[F.col("klass")]
    sequence = bases[F.col("klass")].cast("long") + F.floor(F.col("at") / F.col("klass")).cast("long")
    ahead = Window.partitionBy("sequence_id").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    filled = numbered.where(complete).withColumn("sequence_id", sequence)
    filled = filled.select(*columns, "sequence_id", F.coalesce(F.sum("length").over(ahead), F.lit(0)).cast("long").alias("offset"))
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, bin long, offset long"
    rest = numbered.where(~complete).select(*columns).groupBy().applyInArrow(_first_fit(capacity), schema)
    rest = rest.select(*columns, (F.col("bin") + F.lit(used)).alias("sequence_id"), "offset")
    return filled.unionByName(rest)


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, grid: int = GRID, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents with the sequence and the place each lies in."""
    return pack(token_pieces(docs, path or common.tokenizer_path(), capacity, grid, end_id), capacity)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(common.table(spark, sf_dir, "documents"))
