"""Token ids in block files: each document a zstandard frame of its own, with a dictionary trained on id arrays.

A dataset has three Parquet tables below one folder. ``dictionary`` is one row
(hash, bytes). ``blocks`` holds runs of documents in ascending doc_id order:
the frames end to end in one binary value, and the offset index (doc_ids,
offsets, n_tokens), so that a reader prunes by first_doc_id / last_doc_id and
decompresses only the frames it wants. ``shards`` has the ids before each
shard. Ids are stored little-endian, two bytes each where the vocabulary
allows, else four.
"""

from __future__ import annotations

import functools
import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pacewell.llm import common, encoding
from pacewell.session import scratch_path

END_ID = 0
LEVEL = 3
BLOCK_BYTES = 1 << 20
SAMPLE_DOCS = 400
SAMPLE_CHARS = 20_000
DICTIONARY_BYTES = 64 << 10

BLOCKS = (
    "shard int, block int, first_doc_id long, last_doc_id long, n_docs int, block_tokens long, width int,"
    " dictionary_hash string, doc_ids array<long>, offsets array<long>, n_tokens array<long>, frames binary"
)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def train_dictionary(docs: DataFrame, path: str, width: int, end_id: int = END_ID, size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary of at most ``size`` bytes from a bounded sample.

    The sample is the SAMPLE_DOCS documents of at most SAMPLE_CHARS characters
    with the smallest hashed ids; only compression depends on it, never a
    result. Too few samples for training give their own bytes as dictionary,
    none an empty one.
    """
    order = F.xxhash64("doc_id"), F.col("doc_id")
    sample = _texts(docs).where(F.length("text") <= SAMPLE_CHARS).orderBy(*order).limit(SAMPLE_DOCS).select("text").toArrow()["text"]
    kind, arrays = np.dtype(f"<u{width}"), []
    if len(sample):
        for _, ids, bounds in encoding.encoder(path).encode(sample):
            arrays += [np.append(ids[a:b], end_id).astype(kind).tobytes() for a, b in zip(bounds, bounds[1:])]
    try:
        return zstandard.train_dictionary(size, arrays).as_bytes()
    except zstandard.ZstdError:
        return b"".join(arrays)[:size]


@functools.lru_cache(maxsize=4)
def _dictionary(raw: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(raw) if raw else None


def _encode_blocks(path: str, width: int, dictionary: bytes, end_id: int):
    name = hashlib.sha256(dictionary).hexdigest()
    kind = np.dtype(f"<u{width}")
    schema = pa.schema([
        ("shard", pa.int32()), ("block", pa.int32()), ("first_doc_id", pa.int64()), ("last_doc_id", pa.int64()), ("n_docs", pa.int32()),
        ("block_tokens", pa.int64()), ("width", pa.int32()), ("dictionary_hash", pa.string()), ("doc_ids", pa.list_(pa.int64())),
        ("offsets", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int64())), ("frames", pa.binary()),
    ])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block = TaskContext.get().partitionId(), 0
        writer = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(dictionary), write_checksum=True)
        doc_ids, sizes, frames, held = [], [], [], 0

        def flush():
            nonlocal doc_ids, sizes, frames, held, block
            offsets = np.cumsum([0, *map(len, frames)]).tolist()
            known = [i for i in doc_ids if i is not None]
            row = (shard, block, min(known, default=None), max(known, default=None), len(doc_ids), sum(sizes), width, name, doc_ids, offsets, sizes, b"".join(frames))
            doc_ids, sizes, frames, held, block = [], [], [], 0, block + 1
            return common.record_batch(schema, *([x] for x in row))

        for batch in batches:
            ids_of = batch.column("doc_id").to_pylist()
            for first, ids, bounds in encoding.encoder(path).encode(batch.column("text")):
                for row, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist()), first):
                    frame = writer.compress(np.append(ids[a:b], np.uint32(end_id)).astype(kind).tobytes())
                    doc_ids.append(ids_of[row])
                    sizes.append(b - a + 1)
                    frames.append(frame)
                    held += len(frame)
                    if held >= BLOCK_BYTES:
                        yield flush()
        if doc_ids:
            yield flush()

    return encode


def write_tokens(docs: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID) -> None:
    """Encodes every whole text and writes the dataset below ``folder``.

    Documents are dealt into shards by ranges of doc_id and sorted within them,
    nulls first; equal ids follow by the hash of their text. A null text is
    empty, an empty text its end id alone; other columns are not read. An empty
    table writes tables without rows.
    """
    path = path or common.tokenizer_path()
    spark = docs.sparkSession
    width = 2 if len(encoding.encoder(path).bytes_of) <= 1 << 16 and end_id < 1 << 16 else 4
    dictionary = train_dictionary(docs, path, width, end_id)
    ordered = _texts(docs).repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    ordered.mapInArrow(_encode_blocks(path, width, dictionary, end_id), BLOCKS).write.parquet(f"{folder}/blocks")
    spark.createDataFrame([(hashlib.sha256(dictionary).hexdigest(), dictionary)], "hash string, bytes binary").write.parquet(f"{folder}/dictionary")
    shards = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks").groupBy("shard").agg(F.sum("block_tokens").alias("n"))
    before = F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))  # one row per shard
    shards.select("shard", "n", F.coalesce(before, F.lit(0)).alias("before")).write.parquet(f"{folder}/shards")


def load_dictionary(spark: SparkSession, folder: str) -> bytes:
    return bytes(spark.read.parquet(f"{folder}/dictionary").head()["bytes"])


def _decoded(dictionary: bytes, rows: pa.RecordBatch):
    name = hashlib.sha256(dictionary).hexdigest()
    reader = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))
    for row in rows.to_pylist():
        if row["dictionary_hash"] != name:
            raise ValueError(f"block {row['shard']}/{row['block']} was written with another dictionary")
        frames = memoryview(row["frames"])
        for at, doc_id in enumerate(row["doc_ids"]):
            raw = reader.decompress(frames[row["offsets"][at] : row["offsets"][at + 1]])
            yield row, at, doc_id, np.frombuffer(raw, f"<u{row['width']}").astype("<u4")


def read_tokens(spark: SparkSession, folder: str, doc_ids: list[int] | None = None) -> DataFrame:
    """(doc_id, ids) of all documents, or of the few that are named: blocks are pruned, other frames stay compressed."""
    dictionary = load_dictionary(spark, folder)
    blocks = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")
    wanted = None if doc_ids is None else frozenset(doc_ids)
    if wanted is not None:
        near = F.lit(False)
        for i in sorted(wanted):
            near = near | ((F.col("first_doc_id") <= i) & (F.col("last_doc_id") >= i))
        blocks = blocks.where(near)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int64()))])
        for batch in batches:
            for one in (batch.slice(i, 1) for i in range(len(batch))):
                if wanted is not None:
                    one = _only(one, wanted)
                rows = [(doc_id, ids.astype("int64")) for _, _, doc_id, ids in _decoded(dictionary, one)]
                if rows:
                    yield common.record_batch(schema, *zip(*rows))

    return blocks.mapInArrow(read, "doc_id long, ids array<long>")


def _only(block: pa.RecordBatch, wanted: frozenset) -> pa.RecordBatch:
    row = block.to_pylist()[0]
    at = [i for i, doc_id in enumerate(row["doc_ids"]) if doc_id in wanted]
    frames = [row["frames"][row["offsets"][i] : row["offsets"][i + 1]] for i in at]
    row |= {"doc_ids": [row["doc_ids"][i] for i in at], "offsets": np.cumsum([0, *map(len, frames)]).tolist(), "frames": b"".join(frames)}
    return pa.RecordBatch.from_pylist([row], schema=block.schema)


def token_digests(spark: SparkSession, folder: str) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens and crc32 of its ids."""
    dictionary = load_dictionary(spark, folder)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
        for batch in batches:
            for one in (batch.slice(i, 1) for i in range(len(batch))):
                rows, start = [], 0
                for row, _, doc_id, ids in _decoded(dictionary, one):
                    rows.append((row["shard"], row["block"], doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
                    start += len(ids)
                if rows:
                    yield common.record_batch(schema, *zip(*rows))

    blocks = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")
    rows = blocks.mapInArrow(read, "shard int, block int, doc_id long, start long, n_tokens long, ids_crc32 long")
    earlier = F.sum("block_tokens").over(Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    index = blocks.select("shard", "block", "block_tokens").select("shard", "block", F.coalesce(earlier, F.lit(0)).alias("earlier"))
    index = index.join(spark.read.parquet(f"{folder}/shards"), "shard").select("shard", "block", (F.col("earlier") + F.col("before")).alias("before"))
    return rows.join(index, ["shard", "block"]).select("doc_id", (F.col("start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-files")
    write_tokens(common.table(spark, sf_dir, "documents"), folder)
    return token_digests(spark, folder)
