"""Byte-level BPE from a lexicon: frequent words by one walk, all others by merging.

Words are counted over all documents. The most frequent ones, with the ids
that merging gives them, are compiled into a minimal acyclic transducer
(``lexicon``) in the shared folder; Spark hands the file to the executors,
whose workers map it into memory. Encoding cuts texts into pre-tokens, walks
all of a chunk's through the transducer at once, and merges what is not in it
pair by pair in the order of the tokenizer's ranks. The lexicon thus changes
speed only, never an id.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pacewell.llm import common, lexicon, pretokens, textbytes
from pacewell.session import scratch_path

LEXICON_WORDS = 1 << 17
LONGEST_WORD = 64
COUNT_WORDS = 1 << 17
DECODE_IDS = 1 << 18
LEVELS = 16
TOGETHER_BYTES = 32
TOGETHER_WORDS = 4096
NO_RANK = 1 << 40


def _byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class Tokenizer:
    """Merge ranks, added tokens and bytes of ids of one tokenizers file.

    Only plain byte-level BPE is understood: no normaliser, no prefix space, the usual pre-tokens, no dropout.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, cut, decoder = spec["model"], spec["pre_tokenizer"] or {}, spec["decoder"] or {}
        added = spec["added_tokens"]
        plain = (
            model.get("type", "BPE") == "BPE" and not spec["normalizer"] and decoder.get("type") == "ByteLevel" and cut.get("type") == "ByteLevel"
            and not cut["add_prefix_space"] and cut.get("use_regex", True)
            and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback"))
            and not any(t.get(k) for t in added for k in ("lstrip", "rstrip", "single_word"))
            and not any(a is not b and a["content"] in b["content"] for a in added for b in added)
        )
        if not plain:
            raise ValueError(f"{path} is not a plain byte-level BPE tokenizer")
        vocabulary, characters = model["vocab"], _byte_characters()
        self.added = tuple(t["content"] for t in added)
        self.added_ids = np.array([t["id"] for t in added], np.int64)
        self.single = np.zeros(256, np.int64)
        for c, b in characters.items():
            self.single[b] = vocabulary[c]
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.ranks = {(vocabulary[a], vocabulary[b]): (rank, vocabulary[a + b]) for rank, (a, b) in enumerate(pairs)}
        keys = np.array([(a << 32 | b, rank) for (a, b), (rank, _) in sorted(self.ranks.items())], np.int64).reshape(-1, 2)
        self.pair_keys, self.pair_ranks = np.append(keys[:, 0], NO_RANK << 22), np.append(keys[:, 1], NO_RANK)
        self.made = np.zeros(max((r for r, _ in self.ranks.values()), default=0) + 1, np.int64)
        for rank, whole in self.ranks.values():
            self.made[rank] = whole
        tokens = {i: t for t, i in vocabulary.items()} | {t["id"]: t["content"] for t in added}
        spelt = [b""] * (max(tokens) + 1)
        for i, token in tokens.items():
            known = all(c in characters for c in token)
            spelt[i] = bytes(characters[c] for c in token) if known else token.encode()
        self.spelt = np.frombuffer(b"".join(spelt), np.uint8)
        self.spelt_at = np.cumsum([0, *map(len, spelt)])

    def merge(self, word: bytes) -> list[int]:
        """Ids of one pre-token: the pair of lowest rank is merged first, of equals the leftmost."""
        ids = self.single[np.frombuffer(word, np.uint8)].tolist()
        n, ranks = len(ids), self.ranks
        right, left = [*range(1, n), -1], [*range(-1, n - 1)]
        waiting = [(found[0], i, found[1]) for i in range(n - 1) if (found := ranks.get((ids[i], ids[i + 1])))]
        heapq.heapify(waiting)
        while waiting:
            rank, i, whole = heapq.heappop(waiting)
            j = right[i] if ids[i] is not None else -1
            # A neighbour may have been merged since; then the pair is another one.
            if j < 0 or ranks.get((ids[i], ids[j]), (None,))[0] != rank:
                continue
            ids[i], ids[j] = whole, None
            right[i] = k = right[j]
            if k >= 0:
                left[k] = i
                if found := ranks.get((whole, ids[k])):
                    heapq.heappush(waiting, (found[0], i, found[1]))
            if (h := left[i]) >= 0 and (found := ranks.get((ids[h], whole))):
                heapq.heappush(waiting, (found[0], h, found[1]))
        return [i for i in ids if i is not None]

    def _rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 32 | right
        at = np.searchsorted(self.pair_keys, keys)
        at = np.minimum(at, len(self.pair_keys) - 1)
        return np.where((self.pair_keys[at] == keys) & (left >= 0) & (right >= 0), self.pair_ranks[at], NO_RANK)

    def _merge_together(self, words: list[bytes]) -> list[list[int]]:
        """As ``merge`` for short words, each losing one pair in every turn."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        width = int(sizes.max()) + 1
        ids = np.full((len(words), width), -1, np.int64)
        ids[np.arange(width) < sizes[:, None]] = self.single[np.frombuffer(b"".join(words), np.uint8)]
        ranks = np.full((len(words), width), NO_RANK, np.int64)
        ranks[:, :-1] = self._rank_of(ids[:, :-1], ids[:, 1:])
        done, open_, columns = np.full((len(words), width), -1, np.int64), np.arange(len(words)), np.arange(width)
        while len(open_):
            at = ranks.argmin(axis=1)  # the leftmost of equals
            best = ranks[np.arange(len(at)), at]
            over = best == NO_RANK
            if over.any():
                done[open_[over]] = ids[over]
                ids, ranks, open_, at, best = (x[~over] for x in (ids, ranks, open_, at, best))
            every = np.arange(len(open_))
            behind = np.minimum(columns + (columns > at[:, None]), width - 1)
            ids, ranks = np.take_along_axis(ids, behind, axis=1), np.take_along_axis(ranks, behind, axis=1)
            ids[every, at] = self.made[best]
            ranks[every, at] = self._rank_of(ids[every, at], ids[every, np.minimum(at + 1, width - 1)])
            before = np.flatnonzero(at > 0)
            ranks[before, at[before] - 1] = self._rank_of(ids[before, at[before] - 1], ids[before, at[before]])
        kept = done >= 0
        flat, ends = done[kept].tolist(), np.cumsum(kept.sum(axis=1)).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def merge_all(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each of many pre-tokens."""
        out: list[list[int]] = [[]] * len(words)
        order = sorted((i for i, w in enumerate(words) if 0 < len(w) <= TOGETHER_BYTES), key=lambda i: len(words[i]))
        for first in range(0, len(order), TOGETHER_WORDS):
            some = order[first : first + TOGETHER_WORDS]
            for i, ids in zip(some, self._merge_together([words[i] for i in some])):
                out[i] = ids
        for i, word in enumerate(words):
            if len(word) > TOGETHER_BYTES:
                out[i] = self.merge(word)
        return out

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """UTF-8 of each run of ids; ids outside the vocabulary say nothing, and what is no character becomes U+FFFD."""
        known = (ids >= 0) & (ids < len(self.spelt_at) - 1)
        at = np.where(known, ids, 0)
        starts, sizes = self.spelt_at[at], np.where(known, self.spelt_at[at + 1] - self.spelt_at[at], 0)
        reached = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(sizes, out=reached[1:])
        raw = self.spelt[np.repeat(starts - reached[:-1], sizes) + np.arange(reached[-1])].tobytes()
        ends = reached[bounds].tolist()
        return [raw[a:b].decode("utf-8", "replace").encode() for a, b in zip(ends, ends[1:])]


@functools.cache
def tokenizer(path: str) -> Tokenizer:
    return Tokenizer(path)


class Encoder:
    """Ids of texts by a tokenizer and a lexicon of its words (or none)."""

    def __init__(self, rules: Tokenizer, words: lexicon.Lexicon | None):
        self.rules, self.words = rules, words

    def encode(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first row, ids, bounds of the rows' ids) for runs of rows; null texts are empty."""
        for first, _, data, offsets in textbytes.chunks(texts):
            starts, added = pretokens.split(data, offsets, self.rules.added)
            ends = np.append(starts[1:], len(data))[: len(starts)]
            place = self.words.find(data, starts, ends, LONGEST_WORD) if self.words else np.full(len(starts), -1)
            flat, at = (self.words.ids, self.words.offsets) if self.words else (np.zeros(0, np.int32), np.zeros(1, np.int64))
            known = place >= 0
            source, size = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
            source[known] = at[place[known]]
            size[known] = at[place[known] + 1] - source[known]
            raw, more = data.tobytes(), self.rules.added_ids.tolist()
            special = added >= 0
            source[special], size[special] = len(flat) + added[special], 1
            rest = np.flatnonzero(~known & ~special)
            distinct: dict[bytes, int] = {}
            which = [distinct.setdefault(raw[a:b], len(distinct)) for a, b in zip(starts[rest].tolist(), ends[rest].tolist())]
            lists = self.rules.merge_all(list(distinct))
            sizes = np.fromiter(map(len, lists), np.int64, len(lists))
            source[rest] = (len(flat) + len(more) + np.cumsum(sizes) - sizes)[which]
            size[rest] = sizes[which]
            more += [i for x in lists for i in x]
            every = np.concatenate([flat, np.array(more, np.int32)]) if more else flat
            bounds = np.zeros(len(starts) + 1, np.int64)
            np.cumsum(size, out=bounds[1:])
            ids = every[np.repeat(source - bounds[:-1], size) + np.arange(bounds[-1])]
            yield first, ids, bounds[np.searchsorted(starts, offsets)]


@functools.lru_cache(maxsize=2)
def _encoder(path: str, name: str | None) -> Encoder:
    """One per worker process, tokenizer and lexicon."""
    return Encoder(tokenizer(path), lexicon.Lexicon.mapped(SparkFiles.get(name)) if name else None)


def _text(docs: DataFrame) -> Column:
    """Null is empty; bytes that are not UTF-8 count as U+FFFD."""
    return F.coalesce(F.make_valid_utf8(F.col("text").cast("string")), F.lit(""))


def word_counts(docs: DataFrame, path: str) -> DataFrame:
    """(word binary, n): how often each pre-token of at most LONGEST_WORD bytes stands in all texts.

    Added tokens are no words. Tasks add up before anything is shuffled, COUNT_WORDS words at a time. Null and empty texts and empty tables give none.
    """
    added = tokenizer(path).added

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])
        counts: dict[bytes, int] = {}
        for batch in batches:
            for _, _, data, offsets in textbytes.chunks(batch.column("text")):
                starts, which = pretokens.split(data, offsets, added)
                ends = np.append(starts[1:], len(data))[: len(starts)]
                own = (which < 0) & (ends - starts <= LONGEST_WORD)
                starts, ends = starts[own], ends[own]
                _, at, n = np.unique(textbytes.hash_spans(data, starts, ends), return_index=True, return_counts=True)
                raw = data.tobytes()
                for a, b, m in zip(starts[at].tolist(), ends[at].tolist(), n.tolist()):
                    counts[raw[a:b]] = counts.get(raw[a:b], 0) + m
                if len(counts) >= COUNT_WORDS:
                    yield common.record_batch(schema, list(counts), list(counts.values()))
                    counts = {}
        if counts:
            yield common.record_batch(schema, list(counts), list(counts.values()))

    counted = docs.select(_text(docs).alias("text")).mapInArrow(count, "word binary, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Handle:
    """A lexicon that executors have: its file in the shared folder and the name Spark knows it by."""

    path: str
    name: str
    n_words: int


def compile_lexicon(docs: DataFrame, path: str | None = None, most: int = LEXICON_WORDS) -> Handle:
    """Compiles the most frequent words of all texts, ``most`` at most, and hands the file to the executors.

    Words are taken by levels of frequency, LEVELS to a doubling, whole levels
    only; so the choice needs no sort and reruns agree. At most ``most`` words
    of LONGEST_WORD bytes with their ids reach the driver. Without words the
    lexicon is empty.
    """
    path = path or common.tokenizer_path()
    spark = docs.sparkSession
    level = F.floor(F.log2(F.col("n")) * LEVELS).cast("int").alias("level")
    counts = common.stored(word_counts(docs, path).select("word", level), "words")
    left, lowest = most, None
    for row in counts.groupBy("level").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("level")).collect():
        left -= row["n"]
        if left < 0:
            break
        lowest = row["level"]

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = tokenizer(path)
        schema = pa.schema([("word", pa.binary()), ("ids", pa.list_(pa.int32()))])
        for batch in batches:
            words = batch.column("word").to_pylist()
            yield common.record_batch(schema, words, rules.merge_all(words))

    frequent = counts.where(F.col("level") >= (lowest if lowest is not None else 1 << 20)).select("word")
    found = sorted((bytes(r["word"]), r["ids"]) for r in frequent.mapInArrow(merge, "word binary, ids array<int>").collect())
    file = lexicon.packed(lexicon.build([w for w, _ in found], [i for _, i in found]))
    target = f"{scratch_path(spark, 'lexicon')}.bin"
    _write(spark, target, file)
    spark.sparkContext.addFile(target)
    return Handle(target, target.rsplit("/", 1)[1], len(found))


def _write(spark: SparkSession, path: str, content: bytes) -> None:
    """One bounded file into the shared folder, wherever that is."""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    out = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place)
    try:
        for at in range(0, len(content), 1 << 20):
            out.write(bytearray(content[at : at + (1 << 20)]))
    finally:
        out.close()


def encode(docs: DataFrame, handle: Handle | None = None, path: str | None = None) -> DataFrame:
    """(doc_id, ids array<int>): every whole text as the tokenizer gives it without special tokens of its own.

    Added tokens that a text spells out are theirs. A null or empty text has
    no ids; null ids and repeated rows stay; other columns are not read.
    Without a lexicon every word is merged.
    """
    path = path or common.tokenizer_path()
    name = handle.name if handle else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
        for batch in batches:
            for first, ids, bounds in _encoder(path, name).encode(batch.column("text")):
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, len(lists)), lists], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text(docs).alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, text) of (doc_id, ids) rows.

    The hash is over the ids as little-endian unsigned 32-bit integers. Null
    lists are empty, null ids are left out; ids outside the vocabulary count
    but say nothing in the text.
    """
    path = path or common.tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("text", pa.string())])
        for batch in batches:
            lists = batch.column("ids")
            bounds = np.zeros(len(lists) + 1, np.int64)
            np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), out=bounds[1:])
            every, first = lists.flatten(), 0
            while first < len(lists):
                end = max(first + 1, int(np.searchsorted(bounds, bounds[first] + DECODE_IDS, side="right")) - 1)
                own = bounds[first : end + 1] - bounds[first]
                ids = every.slice(bounds[first], own[-1]).to_numpy(zero_copy_only=False)
                raw = ids.astype("<u4").tobytes()
                hashes = [hashlib.sha256(raw[4 * a : 4 * b]).hexdigest() for a, b in zip(own.tolist(), own[1:].tolist())]
                texts = pa.array(tokenizer(path).decode(ids, own), pa.binary()).cast(pa.string())
                yield common.record_batch(schema, batch.column("doc_id").slice(first, end - first), np.diff(own), hashes, texts)
                first = end

    rows = encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.array_compact(F.col("ids").cast("array<long>")).alias("ids"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, text string")


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids and what they decode to, as counts and hashes."""
    docs = common.table(spark, sf_dir, "documents")
    decoded = decode(encode(docs, compile_lexicon(docs)))
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("text", 256).alias("decoded_sha256"))
