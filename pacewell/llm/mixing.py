"""Mixing sources to target weights by fitting budgets of words with whole documents.

Targets share the total by weight, no source above ``most_repeats`` times its
size. A source takes every document as often as fits its target, and fills the
rest of the budget by subset sum: documents are counted by exact size, each
size gives its proportional share, the difference goes to large sizes first,
and a bounded knapsack closes what is left. Which documents of a size are
taken is decided by seeded hash.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pacewell.llm import common

WORD = r"[^\x20\x09-\x0D]+"
MOST_REPEATS = 3
MOST_SOURCES = 100_000
KNAPSACK = 1 << 14
SALTS = 256
SEED = 42


def words(text: Column) -> Column:
    """Number of runs of characters that are no ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def cyclic_weights(n: int, cycle: tuple[float, ...] = (1.0, 2.0, 3.0)) -> list[float]:
    return [cycle[i % len(cycle)] for i in range(n)]


def targets(sizes: list[int], weights: list[float], most_repeats: int = MOST_REPEATS) -> list[float]:
    """Shares of the total by weight; what a source cannot hold goes to the others by weight."""
    out, open_, rest = [0.0] * len(sizes), set(range(len(sizes))), float(sum(sizes))
    while open_:
        total = sum(weights[i] for i in open_)
        over = [i for i in open_ if total <= 0 or rest * weights[i] / total > most_repeats * sizes[i]]
        if not over:
            for i in open_:
                out[i] = rest * weights[i] / total
            break
        for i in over:
            out[i] = float(min(most_repeats * sizes[i], rest)) if total > 0 else 0.0
        rest -= sum(out[i] for i in over)
        open_ -= set(over)
    return out


def knapsack(sizes: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many of each size to take so that their sum comes nearest to the budget, at most ``counts``.

    Exact for the sums below the budget plus the smallest size; counts are split
    into powers of two, and each sum remembers the first piece that reached it.
    """
    taken = np.zeros(len(sizes), np.int64)
    usable = np.flatnonzero((counts > 0) & (sizes > 0))
    if budget <= 0 or not len(usable):
        return taken
    top = int(budget + sizes[usable].min())
    reached = np.zeros(top + 1, bool)
    reached[0] = True
    by = np.full(top + 1, -1, np.int64)
    pieces: list[tuple[int, int]] = []
    for i in usable.tolist():
        left, part = min(int(counts[i]), top // int(sizes[i])), 1
        while left > 0:
            n = min(part, left)
            width = n * int(sizes[i])
            new = np.zeros_like(reached)
            new[width:] = reached[: top + 1 - width]
            new &= ~reached
            by[new] = len(pieces)
            reached |= new
            pieces.append((i, n))
            left, part = left - n, 2 * part
        if reached[budget]:
            break
    sums = np.flatnonzero(reached)
    at = int(sums[np.abs(sums - budget).argmin()])
    while at:
        i, n = pieces[by[at]]
        taken[i] += n
        at -= n * int(sizes[i])
    return taken


def fit_budget(sizes: np.ndarray, counts: np.ndarray, budget: float) -> np.ndarray:
    """Numbers of documents of each size whose words come nearest to the budget, at most ``counts``."""
    total = int((sizes * counts).sum())
    if budget >= total:
        return counts.copy()
    taken = np.floor(counts * (budget / total)).astype(np.int64) if total else np.zeros_like(counts)
    rest = int(round(budget)) - int((sizes * taken).sum())
    for i in np.argsort(-sizes, kind="stable").tolist():  # large sizes first, down to what the knapsack closes
        if rest <= KNAPSACK:
            break
        if sizes[i] > 0:
            n = min(int(counts[i] - taken[i]), (rest - KNAPSACK) // int(sizes[i]) + 1, rest // int(sizes[i]))
            taken[i] += n
            rest -= n * int(sizes[i])
    return taken + knapsack(sizes, counts - taken, rest)


def _plan(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("size", kind="stable")
    sizes, counts = rows["size"].to_numpy(np.int64), rows["n"].to_numpy(np.int64)
    total, target = int((sizes * counts).sum()), float(rows["target"].iloc[0])
    passes = int(target // total) if total else 0
    extra = fit_budget(sizes, counts, target - passes * total) if total else np.zeros_like(counts)
    return rows.assign(passes=np.int64(passes), extra=extra)[["source", "size", "n", "target", "source_size", "passes", "extra"]]


def mix(docs: DataFrame, weights=cyclic_weights, most_repeats: int = MOST_REPEATS, seed: int = SEED, key: Column | None = None) -> DataFrame:
    """(doc_id, text_key, size, source, source_size, target, taken) of every row; text_key is a hash of the text, or the ``key`` given.

    ``weights`` maps the number of sources to their weights in the order of
    code points, null last. A null source is a source of its own; null and
    empty texts have size 0 and take nothing; repeated rows count each; an
    empty table gives no rows; other columns are not read. More than
    MOST_SOURCES sources are an error, since their totals meet on the driver.
    """
    spark = docs.sparkSession
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), words(F.col("text").cast("string")).alias("size"),
        (F.xxhash64(F.col("text").cast("string")) if key is None else key).alias("text_key"),
    )
    sized = sized.withColumn("place", F.xxhash64("doc_id", F.lit(seed)))
    sized = common.stored(sized.withColumn("salt", F.pmod("place", F.lit(SALTS)).cast("int")), "sizes")
    counts = sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")).limit(MOST_SOURCES + 1).collect()
    if len(totals) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    totals = sorted((r["source"] is None, r["source"] or "", r["source_size"]) for r in totals)
    shares = targets([t[2] for t in totals], weights(len(totals)), most_repeats)
    rows = [(None if null else name, size, share) for (null, name, size), share in zip(totals, shares)]
    shares = spark.createDataFrame(rows, "named string, source_size long, target double")
    counts = counts.join(shares, F.col("source").eqNullSafe(F.col("named"))).drop("named")
    plan = counts.groupBy("source").applyInPandas(
        _plan, "source string, size long, n long, target double, source_size long, passes long, extra long"
    )
    # Place of a document among those of its source and size, in two steps: salts first, then within a salt.
    salted = sized.groupBy("source", "size", "salt").agg(F.count(F.lit(1)).alias("n_salt"))
    earlier = F.sum("n_salt").over(Window.partitionBy("source", "size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))
    salted = salted.select("source", "size", "salt", F.coalesce(earlier, F.lit(0)).alias("earlier"))
    names = {c: c + "_" for c in ("source", "size", "salt")}
    plan = plan.withColumnsRenamed({"source": "source_p", "size": "size_p"})
    salted = salted.join(plan, F.col("source").eqNullSafe(F.col("source_p")) & (F.col("size") == F.col("size_p"))).drop("source_p", "size_p")
    own = F.row_number().over(Window.partitionBy("source", "size", "salt").orderBy("place", "doc_id", "text_key"))
    ranked = sized.withColumn("own", own)
    same = F.col("source").eqNullSafe(F.col("source_")) & (F.col("size") == F.col("size_")) & (F.col("salt") == F.col("salt_"))
    joined = ranked.join(salted.withColumnsRenamed(names), same)
    taken = F.col("passes") + F.when(F.col("earlier") + F.col("own") <= F.col("extra"), 1).otherwise(0)
    return joined.select("doc_id", "text_key", "size", "source", "source_size", "target", (F.col("size") * taken).alias("taken"))


def mixed_documents(docs: DataFrame, weights=cyclic_weights, most_repeats: int = MOST_REPEATS, seed: int = SEED) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with all of its own columns.

    Null and empty texts and others without words are not taken. Rows are told
    apart by a hash of all columns; rows equal in all of them stand in for each other.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    key = F.xxhash64(*columns, *[c.isNull() for c in columns])
    plan = mix(docs, weights, most_repeats, seed, key).where("taken > 0")
    times = F.sum(F.col("taken") / F.col("size")).cast("int").alias("__times")
    plan = plan.groupBy("doc_id", "text_key", "source").agg(times)
    plan = plan.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), F.col("source").alias("__source"), "__times")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (key == F.col("__key"))
    joined = docs.join(plan, same & F.col("source").cast("string").eqNullSafe(F.col("__source"))).dropDuplicates(["__id", "__key", "__source"])
    return joined.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times")))).select(*docs.columns)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(common.table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
