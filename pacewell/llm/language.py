"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams of whole texts per language inside the tasks and sums
the counts in Spark; the table of log-probabilities has at most MOST_LANGUAGES
x BUCKETS entries and is broadcast. Scoring treats a batch as a sparse matrix
of n-gram occurrences and multiplies it with that table in numpy.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pacewell.llm import common, textbytes

BUCKETS = 1 << 14
ORDERS = (1, 2, 3)
MOST_LANGUAGES = 128
SMOOTHING = 0.5
UNDETERMINED = "und"


@functools.cache
def _characters() -> tuple[np.ndarray, np.ndarray]:
    """Lower-case form and letter mark of every code point; forms of more than one character stay as they are."""
    lower, letter = np.arange(0x110000, dtype=np.uint32), np.zeros(0x110000, bool)
    for code in range(0x110000):
        c = chr(code)
        if c.isalpha():
            letter[code] = True
            if len(low := c.lower()) == 1:
                lower[code] = ord(low)
    return np.where(letter, lower, np.uint32(32)), letter


def grams(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, list[np.ndarray]]]:
    """(first row, letters per row, offsets of rows, buckets per order) of runs of rows.

    Characters that are no letters count as one blank. Grams that would reach
    over the end of a text get the bucket BUCKETS, which weighs nothing.
    """
    lower, letter = _characters()
    for first, _, data, offsets in textbytes.chunks(texts):
        codes = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le", "replace"), np.uint32)
        counts = textbytes.code_points(data, offsets)
        bounds = np.zeros(len(counts) + 1, np.int64)
        np.cumsum(counts, out=bounds[1:])
        letters = textbytes.sums(letter[codes].astype(np.int64), bounds)
        codes = lower[codes]
        orders, key = [], np.zeros(len(codes), np.uint32)
        for n in ORDERS:
            key = key * np.uint32(0x01000193)
            key[: len(codes) - n + 1] += codes[n - 1 :] + np.uint32(n)
            bucket = (key * np.uint32(0x9E3779B1) >> np.uint32(32 - 14)).astype(np.int32)
            for back in range(1, n):
                last = bounds[1:] - back
                bucket[last[last >= bounds[:-1]]] = BUCKETS
            orders.append(bucket)
        yield first, letters, bounds, orders


@dataclass(frozen=True)
class LanguageModel:
    """Languages by code point order, log-priors, and log-probabilities by language and bucket."""

    languages: list[str]
    priors: np.ndarray
    table: np.ndarray

    def score(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """Language and posterior of each text; ``und`` and 0 without a letter or without languages."""
        names, scores = [], []
        for _, letters, bounds, orders in grams(texts):
            if not self.languages:
                names += [UNDETERMINED] * len(letters)
                scores.append(np.zeros(len(letters)))
                continue
            totals = np.empty((len(letters), len(self.languages)))
            for at, row in enumerate(self.table):
                totals[:, at] = self.priors[at] + sum(textbytes.sums(row[bucket].astype(np.float64), bounds) for bucket in orders)
            best = totals.argmax(axis=1)
            share = np.exp(totals - totals.max(axis=1, keepdims=True))
            share = share[np.arange(len(best)), best] / share.sum(axis=1)
            names += [self.languages[b] if n else UNDETERMINED for b, n in zip(best.tolist(), letters.tolist())]
            scores.append(np.where(letters > 0, share, 0.0))
        return names, np.concatenate(scores) if scores else np.zeros(0)


def fit(docs: DataFrame) -> LanguageModel:
    """Learns from all rows with a language; null texts count for the prior only.

    More than MOST_LANGUAGES languages are an error, since the model must stay
    small enough to broadcast. An empty table gives a model without languages.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("n", pa.int64())])
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            codes = batch.column("lang").dictionary_encode()
            names, of_row = codes.dictionary.to_pylist(), codes.indices.to_numpy()
            for first, letters, bounds, orders in grams(batch.column("text")):
                own = of_row[first : first + len(letters)]
                present, local = np.unique(own, return_inverse=True)
                size = BUCKETS + 1
                shift = np.repeat(local * size, np.diff(bounds))
                found = sum(np.bincount(shift + bucket, minlength=len(present) * size) for bucket in orders)
                found = np.reshape(found, (len(present), size)).astype(np.int64)
                found[:, BUCKETS] = np.bincount(local, minlength=len(present))  # the spare column counts texts
                for at, name in enumerate(present.tolist()):
                    total[names[name]] = total.get(names[name], 0) + found[at]
        for name, counts in total.items():
            buckets = np.flatnonzero(counts)
            yield common.record_batch(schema, [name] * len(buckets), buckets.astype(np.int32), counts[buckets])

    rows = docs.where(F.col("lang").isNotNull()).select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    counts = rows.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    counts = common.stored(counts, "gram-counts")
    languages = sorted(r["lang"] for r in counts.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect())
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    found = counts.toArrow().to_pydict() if languages else {"lang": [], "bucket": [], "n": []}
    numbers = np.zeros((len(languages), BUCKETS + 1))
    place = {name: at for at, name in enumerate(languages)}
    numbers[[place[x] for x in found["lang"]], found["bucket"]] = found["n"]
    texts, grams_of = numbers[:, BUCKETS], numbers[:, :BUCKETS] + SMOOTHING
    table = np.zeros((len(languages), BUCKETS + 1), np.float32)
    table[:, :BUCKETS] = np.log(grams_of / grams_of.sum(axis=1, keepdims=True))
    return LanguageModel(languages, np.log(texts / texts.sum()) if languages else texts, table)


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, lang_pred, score) of every row; null texts are undetermined with score 0, repeated rows stay."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])
        for batch in batches:
            names, scores = shared.value.score(batch.column("text"))
            yield common.record_batch(schema, batch.column("doc_id"), names, scores)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(score, "doc_id long, lang_pred string, score double")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(common.fold(doc_id, 3) == 1, F.lit(False))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out(F.col("doc_id"))))
    return predict(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
