"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature of a whole text falls into a bin; the score is the logistic of an
intercept plus one table entry per feature plus one per pair of features. The
tables are learned by cyclic boosting: round after round, one shallow tree per
feature (three leaves) and later per pair (four leaves) is fitted to the
gradient of the log loss and added to its table. Learning uses a bounded
sample of labelled rows, of which only the bins reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pacewell.llm import common, textbytes

FEATURES = (
    "log_words", "word_bytes", "long_words", "short_words", "upper", "digits", "marks", "symbols", "mark_words", "doubled_marks",
    "repeated_next", "distinct", "commonest", "line_words", "repeated_lines", "ended_lines", "bare_words",
)
THRESHOLD = 0.7
SAMPLE_ROWS = 40_000
BINS, PAIR_BINS = 32, 8

_UPPER, _DIGIT, _MARK, _SYMBOL = (np.zeros(256, bool) for _ in range(4))
_UPPER[65:91] = True
_DIGIT[48:58] = True
_MARK[[ord(c) for c in ".,;:!?'\"()-"]] = True
_SYMBOL[[c for c in range(0x21, 0x7F) if not chr(c).isalnum() and not _MARK[c]]] = True


def _distinct_share(keys: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of distinct keys in each row, and the count of each row's commonest key."""
    order = np.lexsort((keys, rows))
    keys, rows = keys[order], rows[order]
    opens = np.ones(len(keys), bool)
    opens[1:] = (keys[1:] != keys[:-1]) | (rows[1:] != rows[:-1])
    at = np.flatnonzero(opens)
    most = np.zeros(n)
    np.maximum.at(most, rows[at], np.diff(np.append(at, len(keys))))
    return np.bincount(rows[at], minlength=n).astype(float), most


def text_features(texts: pa.Array) -> np.ndarray:
    """One row of FEATURES per text; a null or empty text has zeros."""
    out = np.zeros((len(texts), len(FEATURES)), np.float32)
    for first, end, data, offsets in textbytes.chunks(texts):
        n = end - first
        starts, ends, rows = textbytes.word_spans(data, offsets)
        words = np.bincount(rows, minlength=n).astype(float)
        some, length = np.maximum(words, 1), ends - starts

        def share(marks: np.ndarray, of: np.ndarray = some, rows: np.ndarray = rows) -> np.ndarray:
            return np.bincount(rows, marks, minlength=n) / of

        def bytes_of(kind: np.ndarray, of: np.ndarray) -> np.ndarray:
            return textbytes.sums(kind[data].astype(np.int64), offsets) / np.maximum(of, 1)

        visible = np.bincount(rows, length, minlength=n)
        odd = np.zeros(len(data) + 1, np.int64)
        np.cumsum(_SYMBOL[data], out=odd[1:])
        keys = textbytes.hash_spans(data, starts, ends)
        twice = np.zeros(len(data), bool)
        twice[1:] = (data[1:] == data[:-1]) & (_MARK | _SYMBOL)[data[1:]]
        same = np.zeros(len(keys), bool)
        same[1:] = (keys[1:] == keys[:-1]) & (rows[1:] == rows[:-1])
        distinct, most = _distinct_share(keys, rows, n)
        # Lines: from each text's start and after each line break to the next break or end.
        breaks = np.flatnonzero(data == 10)
        line_starts = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
        line_starts = line_starts[line_starts < len(data)]
        line_ends = np.append(line_starts[1:], len(data))[: len(line_starts)]
        line_rows = np.searchsorted(offsets, line_starts, side="right") - 1
        lines = np.maximum(np.bincount(line_rows, minlength=n), 1).astype(float)
        line_keys = textbytes.hash_spans(data, line_starts, line_ends - (data[line_ends - 1] == 10))
        line_distinct, _ = _distinct_share(line_keys, line_rows, n)
        last = data[ends - 1] if len(ends) else np.zeros(0, np.uint8)
        closing = np.isin(last, [ord(c) for c in ".!?"])
        marked = odd[ends] - odd[starts] > 0
        columns = (
            np.log1p(words), visible / some, share(length > 14), share(length < 3), bytes_of(_UPPER, visible), bytes_of(_DIGIT, visible),
            bytes_of(_MARK, visible), bytes_of(_SYMBOL, visible), share(marked), np.bincount(np.searchsorted(offsets, np.flatnonzero(twice), side="right") - 1, minlength=n) / some,
            share(same), np.where(words > 0, distinct / some, 0), most / some, words / lines, 1 - np.maximum(line_distinct, 1) / lines, share(closing), share(odd[ends] - odd[starts] == length),
        )
        out[first:end] = np.stack(columns, axis=1)
    return out


@dataclass(frozen=True)
class Boosting:
    """How the model learns."""

    rounds: int = 150
    pair_rounds: int = 60
    pairs: int = 8
    rate: float = 0.1
    ridge: float = 1.0
    least_weight: float = 1.0


@dataclass
class AdditiveModel:
    """Cut points and tables of single features, and tables of pairs over coarser bins."""

    intercept: float
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def bins(self, features: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(c, features[:, i], side="right") for i, c in enumerate(self.cuts)], axis=1)

    def score(self, features: np.ndarray) -> np.ndarray:
        """Probability of label 1."""
        bins = self.bins(features)
        total = np.full(len(bins), self.intercept)
        for i, table in enumerate(self.tables):
            total += table[bins[:, i]]
        for a, b, table in self.pairs:
            total += table[self.coarse[a][bins[:, a]], self.coarse[b][bins[:, b]]]
        return 1.0 / (1.0 + np.exp(-total))


def _best_cut(g: np.ndarray, h: np.ndarray, how: Boosting) -> tuple[float, int]:
    """Gain and place of the best cut of a row of bins; the place is the first bin on the right."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    right_g, right_h = g.sum() - left_g, h.sum() - left_h
    gain = left_g**2 / (left_h + how.ridge) + right_g**2 / (right_h + how.ridge) - g.sum() ** 2 / (h.sum() + how.ridge)
    gain = np.where((left_h >= how.least_weight) & (right_h >= how.least_weight), gain, -np.inf)
    return (float(gain.max()), int(gain.argmax()) + 1) if len(gain) else (-np.inf, 0)


def _leaf(g: float, h: float, how: Boosting) -> float:
    return how.rate * g / (h + how.ridge)


def _single_tree(g: np.ndarray, h: np.ndarray, how: Boosting) -> np.ndarray:
    """Steps of a tree of up to three leaves, by bin."""
    edges = [0, len(g)]
    for _ in range(2):
        options = [(*_best_cut(g[a:b], h[a:b], how), a) for a, b in zip(edges, edges[1:])]
        gain, cut, start = max(options)
        if gain <= 0:
            break
        edges = sorted([*edges, start + cut])
    step = np.zeros(len(g))
    for a, b in zip(edges, edges[1:]):
        step[a:b] = _leaf(g[a:b].sum(), h[a:b].sum(), how)
    return step


def _pair_tree(g: np.ndarray, h: np.ndarray, how: Boosting) -> tuple[float, np.ndarray]:
    """Gain and steps of a tree of up to four leaves: a cut of the rows, then one of the columns on either side."""
    step, (gain, cut) = np.zeros_like(g), _best_cut(g.sum(axis=1), h.sum(axis=1), how)
    halves = [slice(0, cut), slice(cut, None)] if gain > 0 else [slice(None)]
    total = max(gain, 0.0)
    for half in halves:
        part_g, part_h = g[half].sum(axis=0), h[half].sum(axis=0)
        gain, at = _best_cut(part_g, part_h, how)
        for side in [slice(0, at), slice(at, None)] if gain > 0 else [slice(None)]:
            step[half, side] = _leaf(part_g[side].sum(), part_h[side].sum(), how)
        total += max(gain, 0.0)
    return total, step


def learn(features: np.ndarray, labels: np.ndarray, how: Boosting = Boosting()) -> AdditiveModel:
    """Fits the tables; labels of one kind, or none, give the smoothed share of label 1 for every text."""
    share = (labels.sum() + 0.5) / (len(labels) + 1.0)
    model = AdditiveModel(float(np.log(share / (1 - share))), [np.zeros(0)] * features.shape[1], [np.zeros(1)] * features.shape[1])
    if len(labels) == 0 or labels.min() == labels.max():
        return model
    points = np.linspace(0, 1, BINS + 1)[1:-1]
    model.cuts = [np.unique(np.quantile(features[:, i], points)) for i in range(features.shape[1])]
    model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
    model.coarse = [np.arange(len(t)) * PAIR_BINS // len(t) for t in model.tables]
    bins, total = model.bins(features), np.full(len(labels), model.intercept)

    def gradient() -> tuple[np.ndarray, np.ndarray]:
        p = 1.0 / (1.0 + np.exp(-total))
        return labels - p, p * (1 - p)

    for _ in range(how.rounds):
        for i, table in enumerate(model.tables):
            g, h = (np.bincount(bins[:, i], x, minlength=len(table)) for x in gradient())
            step = _single_tree(g, h, how)
            table += step
            total += step[bins[:, i]]
    small = np.stack([c[bins[:, i]] for i, c in enumerate(model.coarse)], axis=1)

    def grid(a: int, b: int) -> list[np.ndarray]:
        return [np.bincount(small[:, a] * PAIR_BINS + small[:, b], x, minlength=PAIR_BINS**2).reshape(PAIR_BINS, PAIR_BINS) for x in gradient()]

    ranked = sorted((-_pair_tree(*grid(a, b), how)[0], a, b) for a, b in combinations(range(features.shape[1]), 2))
    model.pairs = [(a, b, np.zeros((PAIR_BINS, PAIR_BINS))) for _, a, b in ranked[: how.pairs]]
    for _ in range(how.pair_rounds):
        for a, b, table in model.pairs:
            _, step = _pair_tree(*grid(a, b), how)
            table += step
            total += step[small[:, a], small[:, b]]
    return model


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, features) of every row, from whole texts."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("features", pa.list_(pa.float32()))])
        for batch in batches:
            found = text_features(batch.column("text"))
            lists = pa.ListArray.from_arrays(np.arange(len(found) + 1, dtype=np.int32) * len(FEATURES), found.ravel())
            yield common.record_batch(schema, batch.column("doc_id"), lists)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(extract, "doc_id long, features array<float>")


def fit(found: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, how: Boosting = Boosting()) -> AdditiveModel:
    """Learns from (doc_id, features) and (doc_id, label) rows.

    About ``sample_rows`` labelled rows take part, chosen by hashed doc_id if
    there are more. Null ids and labels other than 0 and 1 are left out; repeated
    rows count each.
    """
    labels = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("label").cast("double").alias("label")).where("doc_id IS NOT NULL AND label IN (0, 1)")
    n = labels.count()
    if n > sample_rows:
        labels = labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * sample_rows / n))
    rows = found.join(labels, "doc_id").orderBy("doc_id", "label", "features").toArrow()
    x = rows["features"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(rows.num_rows, len(FEATURES))
    return learn(x, rows["label"].to_numpy(), how)


def scores(found: DataFrame, model: AdditiveModel) -> DataFrame:
    """(doc_id, score) from a frame of features."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])
        for batch in batches:
            x = batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(len(batch), len(FEATURES))
            yield common.record_batch(schema, batch.column("doc_id"), model.score(x))

    return found.mapInArrow(score, "doc_id long, score double")


def score_column(model: AdditiveModel, text: Column) -> Column:
    """The score as a column, for filters that keep their other columns out of Python."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(model.score(text_features(texts)))

    return score(text)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(common.fold(doc_id, 4) == 2, F.lit(False))


def training_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = common.table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    return labels.select("doc_id", F.col("quality").alias("label"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = common.stored(features(common.table(spark, sf_dir, "documents")), "features")
    scored = scores(found, fit(found, training_labels(spark, sf_dir)))
    predicted = (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted)
