"""Token counts that follow edits: per document a tree of sums over segments of pre-tokens.

A text is cut into segments of about SEGMENT_BYTES where pre-tokenisation
always cuts, so its count is the sum of its segments' counts. Two trees of
sums over the same segments, of code points and of tokens, are stored as flat
arrays (node i has the children 2i and 2i + 1, the root is 1). An edit finds
its segments by descending the tree of code points, encodes them again with
one character of context on either side, and updates the sums on the way up;
nothing else is encoded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pacewell.llm import common, encoding, textbytes

SEGMENT_BYTES = 512


class SumTree:
    """Sums over a row of numbers; changing one number updates the nodes above it."""

    def __init__(self, nodes: np.ndarray):
        self.nodes = nodes

    @classmethod
    def over(cls, values) -> SumTree:
        width = 1
        while width < len(values):
            width *= 2
        nodes = np.zeros(2 * width, np.int64)
        nodes[width : width + len(values)] = values
        while width > 1:
            nodes[width // 2 : width] = nodes[width : 2 * width : 2] + nodes[width + 1 : 2 * width : 2]
            width //= 2
        return cls(nodes)

    @property
    def total(self) -> int:
        return int(self.nodes[1])

    @property
    def leaves(self) -> np.ndarray:
        return self.nodes[len(self.nodes) // 2 :]

    def put(self, leaf: int, value: int) -> None:
        at = len(self.nodes) // 2 + leaf
        change = value - self.nodes[at]
        while at:
            self.nodes[at] += change
            at //= 2

    def find(self, position: int) -> tuple[int, int]:
        """The leaf that holds a position, and the sum before that leaf."""
        at, before = 1, 0
        while at < len(self.nodes) // 2:
            at *= 2
            if position - before >= self.nodes[at]:
                before += int(self.nodes[at])
                at += 1
        return at - len(self.nodes) // 2, before


def segments(texts: pa.Array, path: str) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, bounds of the rows' segments, code points and tokens of the segments) for runs of rows."""
    for first, _, data, offsets in textbytes.chunks(texts):
        places = np.flatnonzero(encoding.cuts(data))
        starts, counts = [], []
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            wanted = np.searchsorted(places, np.arange(a + SEGMENT_BYTES, b, SEGMENT_BYTES))
            own = np.unique(places[wanted[wanted < len(places)]])
            own = own[own < b]
            starts.append(np.concatenate([[a], own]))
            counts.append(len(own) + 1)
        bounds = np.append(np.concatenate(starts), len(data)).astype(np.int64)
        pieces = pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds), pa.py_buffer(data.tobytes()))
        tokens = np.concatenate([np.diff(b) for _, _, b in encoding.encoder(path).encode(pieces)])
        yield first, np.cumsum([0, *counts]), textbytes.code_points(data, bounds), tokens


_TREES = "doc_id long, text string, n_tokens long, char_tree array<long>, token_tree array<long>"


def build_trees(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, text, n_tokens, char_tree, token_tree) of every row.

    A null or empty text has one empty segment and no tokens; null ids and
    repeated rows stay; other columns are not read.
    """
    path = path or common.tokenizer_path()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = pa.list_(pa.int64())
        schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("n_tokens", pa.int64()), ("char_tree", trees), ("token_tree", trees)])
        for batch in batches:
            for first, bounds, chars, tokens in segments(batch.column("text"), path):
                n, spans = len(bounds) - 1, list(zip(bounds[:-1].tolist(), bounds[1:].tolist()))
                kept = [[SumTree.over(values[a:b]) for a, b in spans] for values in (chars, tokens)]
                own = (batch.column(c).slice(first, n) for c in ("doc_id", "text"))
                yield common.record_batch(schema, *own, [t.total for t in kept[1]], *[[t.nodes for t in trees_] for trees_ in kept])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(build, _TREES)


class _Document:
    """A text with its trees while edits are applied."""

    def __init__(self, text: str, chars, tokens):
        self.text, self.encoded = text, 0
        self.chars, self.tokens = SumTree(np.array(chars, np.int64)), SumTree(np.array(tokens, np.int64))

    def edit(self, start: int, length: int, replacement: str) -> str:
        """Changes the text; returns that of the segments to encode again, which ``count`` then takes in."""
        size = self.chars.total
        start = min(max(start, 0), size)
        end = min(start + max(length, 0), size)
        self.first, at = self.chars.find(min(max(start - 1, 0), max(size - 1, 0)))
        self.last, before = self.chars.find(min(end, max(size - 1, 0)))
        stop = before + int(self.chars.leaves[self.last])
        region = self.text[at:start] + replacement + self.text[end:stop]
        self.text = self.text[:at] + region + self.text[stop:]
        self.encoded += len(region)
        return region

    def count(self, chars: np.ndarray, tokens: np.ndarray) -> None:
        """Puts the new segments in the place of the touched ones."""
        room = self.last - self.first + 1
        for tree, values in (("chars", chars), ("tokens", tokens)):
            own = getattr(self, tree)
            if len(values) <= room:
                for leaf in range(room):
                    own.put(self.first + leaf, int(values[leaf]) if leaf < len(values) else 0)
            else:
                setattr(self, tree, SumTree.over(np.concatenate([own.leaves[: self.first], values, own.leaves[self.last + 1 :]])))


def apply_edits(trees: DataFrame, path: str | None = None) -> DataFrame:
    """Applies the column ``edits`` to documents with their trees.

    ``edits`` is array<struct<start int, length int, text string>>: from the code
    point ``start``, ``length`` code points give way to ``text``; each edit
    meets the text that the one before left. Places beyond the text are moved
    into it, null members count as 0 and empty, a null array is no edit. Gives
    the columns of ``build_trees`` after the edits, tokens_before, and
    encoded_chars, the number of code points that were encoded for them.
    """
    path = path or common.tokenizer_path()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"text": pa.string(), "char_tree": pa.list_(pa.int64()), "token_tree": pa.list_(pa.int64())}
        names = ("doc_id", "text", "n_tokens", "char_tree", "token_tree", "tokens_before", "encoded_chars")
        schema = pa.schema([(c, kinds.get(c, pa.int64())) for c in names])
        for batch in batches:
            for part in (batch.slice(i, 1000) for i in range(0, len(batch), 1000)):
                docs = [_Document(*x) for x in zip(*(part.column(c).to_pylist() for c in ("text", "char_tree", "token_tree")))]
                edits = [x or [] for x in part.column("edits").to_pylist()]
                for turn in range(max(map(len, edits), default=0)):
                    now = [(d, e[turn]) for d, e in zip(docs, edits) if len(e) > turn and e[turn] is not None]
                    regions = [d.edit(e["start"] or 0, e["length"] or 0, e["text"] or "") for d, e in now]
                    for first, bounds, chars, tokens in segments(pa.array(regions, pa.large_string()), path):
                        for at, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist()), first):
                            now[at][0].count(chars[a:b], tokens[a:b])
                yield common.record_batch(
                    schema, part.column("doc_id"), [d.text for d in docs], [d.tokens.total for d in docs], [d.chars.nodes for d in docs],
                    [d.tokens.nodes for d in docs], part.column("n_tokens"), [d.encoded for d in docs],
                )

    return trees.select("doc_id", "text", "n_tokens", "char_tree", "token_tree", "edits").mapInArrow(apply, f"{_TREES}, tokens_before long, encoded_chars long")


def sample_edits(text):
    """Three edits made from the text itself: a short span doubled in place, its start repeated in the middle, its end cut off."""
    n = F.length(text)
    kind = "struct<start:int,length:int,text:string>"
    return F.array(
        F.struct(F.floor(n / 4).cast("int"), F.lit(12), F.repeat(F.substring(text, F.floor(n / 4).cast("int") + 1, F.lit(12)), 2)).cast(kind),
        F.struct(F.floor(n / 2).cast("int"), F.lit(0), F.left(text, F.lit(40))).cast(kind),
        F.struct(F.greatest(n - 20, F.lit(0)), F.lit(20), F.lit("")).cast(kind),
    )


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document before and after three edits; the latter from the kept trees."""
    trees = build_trees(common.table(spark, sf_dir, "documents"))
    after = apply_edits(trees.withColumn("edits", sample_edits(F.col("text"))))
    return after.select("doc_id", F.col("tokens_before").alias("n_tokens"), F.col("n_tokens").alias("edited_tokens"), "encoded_chars", F.length("text").cast("long").alias("edited_chars"))
