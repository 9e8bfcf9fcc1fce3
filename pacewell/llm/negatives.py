"""Hard negatives: exact windows of scores, found with bounds along spanning trees of anchors.

Candidates lie in blocks of bounded size, anchors in parts; a task has one
block and one part. It joins near anchors by minimum spanning trees. A
candidate's score at an anchor lies within (edge length x candidate's norm) of
its score at the parent anchor; where that interval misses the window in which
an anchor still wants rows, nothing is computed, elsewhere the score is
computed anew, in whole numbers. Windows narrow as they fill: an early share
of about the root of the blocks is searched first, and what it finds is the
floor for all other blocks, so that these return little.

In many dimensions vectors that are not near copies of each other are far
apart; edges are then long and few intervals miss a window, so that most of
the scores are computed, a tile at a time.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pacewell.llm import common

POSITIVES = 5
NEGATIVES = 10
LOW_PERCENT, HIGH_PERCENT = 30, 90
MOST_ROWS = 1 << 15
LEAST_ROWS = 1 << 9
BLOCKS = 256
TREE = 256
TILE = 2048
DENSE = 16
WIDEST = 1 << 62


def _matrix(column, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def spanning_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(parent, edge length, depth) of a minimum spanning tree over rows, rooted at the first; the root's parent is -1."""
    n, x = len(points), points.astype(np.float64)
    parent, edge, depth = np.full(n, -1), np.zeros(n), np.zeros(n, np.int64)
    nearest, by = np.full(n, np.inf), np.zeros(n, np.int64)
    out, last = np.ones(n, bool), 0
    for _ in range(n - 1):
        out[last] = False
        far = np.sqrt(((x - x[last]) ** 2).sum(axis=1))
        closer = out & (far < nearest)
        nearest[closer], by[closer] = far[closer], last
        last = int(np.where(out, nearest, np.inf).argmin())
        parent[last], edge[last], depth[last] = by[last], nearest[last], depth[by[last]] + 1
    return parent, edge, depth


class _Search:
    """The best ``k`` rows of each anchor and window among the tiles seen so far."""

    def __init__(self, anchors: np.ndarray, low: np.ndarray, high: np.ndarray, k: int):
        self.anchors, self.low, self.high, self.k = anchors, low.copy(), high, k
        self.parent, self.edge, depth = spanning_tree(anchors)
        self.levels = [np.flatnonzero(depth == d) for d in range(int(depth.max(initial=0)) + 1)] if len(anchors) else []
        self.best = [np.zeros(0, np.int64)] * 4
        self.computed = self.spared = 0

    def see(self, ids: np.ndarray, rows: np.ndarray, allowed: np.ndarray) -> None:
        """Takes in a tile of candidates; ``allowed`` [anchor, row] says which may be partners."""
        exact = float(np.abs(self.anchors).max(initial=0)) * float(np.abs(rows).max(initial=0)) * max(rows.shape[1], 1) < 2.0**53
        a, x = (self.anchors.astype(np.float64), rows.astype(np.float64)) if exact else (self.anchors, rows)
        norms = np.sqrt((x.astype(np.float64) ** 2).sum(axis=1)) * (1 + 1e-9)
        wanted = self.high >= self.low
        floor = np.where(wanted, self.low, WIDEST).min(axis=1).astype(np.float64)
        ceiling = np.where(wanted, self.high, -WIDEST).max(axis=1).astype(np.float64)
        low, high = (np.zeros((len(a), len(x))) for _ in range(2))
        for nodes in self.levels:
            up = self.parent[nodes]
            need = allowed[nodes]
            if exact and up[0] >= 0:
                spread = self.edge[nodes, None] * norms[None, :] + 1
                low[nodes], high[nodes] = low[up] - spread, high[up] + spread
                need = need & (high[nodes] >= floor[nodes, None]) & (low[nodes] <= ceiling[nodes, None])
            n = int(need.sum())
            self.spared += int(allowed[nodes].sum()) - n
            self.computed += n
            if not exact or up[0] < 0 or n * DENSE > need.size:
                scores = a[nodes] @ x.T if exact else np.einsum("id,jd->ij", a[nodes], x)
                low[nodes] = high[nodes] = scores
                self._take(nodes, ids, scores, need)
            elif n:
                i, j = np.nonzero(need)
                for at in range(0, n, TILE * DENSE):
                    some = slice(at, at + TILE * DENSE)
                    scores = np.einsum("nd,nd->n", a[nodes[i[some]]], x[j[some]])
                    low[nodes[i[some]], j[some]] = high[nodes[i[some]], j[some]] = scores
                self._take(nodes, ids, low[nodes], need)
        self._settle()

    def _take(self, nodes: np.ndarray, ids: np.ndarray, scores: np.ndarray, need: np.ndarray) -> None:
        """Puts rows inside each window to the best ones; of many, those below the k-th are left out."""
        scores = scores.astype(np.int64)
        for slot in range(self.low.shape[1]):
            inside = need & (scores >= self.low[nodes, slot, None]) & (scores <= self.high[nodes, slot, None])
            many = np.flatnonzero(inside.sum(axis=1) > 4 * self.k)
            if len(many):
                kth = np.partition(np.where(inside[many], scores[many], -WIDEST), -self.k, axis=1)[:, -self.k]
                inside[many] &= scores[many] >= kth[:, None]
            i, j = np.nonzero(inside)
            found = (nodes[i], np.full(len(i), slot), ids[j], scores[i, j])
            self.best = [np.concatenate([b, f]) for b, f in zip(self.best, found)]

    def _settle(self) -> None:
        node, slot, ids, scores = self.best
        order = np.lexsort((ids, -scores, slot, node))
        place = (node * self.low.shape[1] + slot)[order]
        first = np.flatnonzero(np.append(True, place[1:] != place[:-1])) if len(place) else np.zeros(0, np.int64)
        rank = np.arange(len(place)) - np.repeat(first, np.diff(np.append(first, len(place))))
        self.best = [b[order][rank < self.k] for b in self.best]
        full = order[rank == self.k - 1]
        self.low[node[full], slot[full]] = np.maximum(self.low[node[full], slot[full]], scores[full])


def _near_first(anchors: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """An order in which near anchors mostly stand together: by the nearest of the first few."""
    x = anchors.astype(np.float64)
    pivots = x[np.argsort(ids, kind="stable")[:64]]
    far = (x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1)[None, :] - 2 * x @ pivots.T
    return np.lexsort((ids, far.argmin(axis=1)))


def _solve(k: int, same_label: bool, windows):
    """Task of a block of candidates and a part of anchors."""

    def solve(key, data: pa.Table, anchors: pa.Table) -> pa.Table:
        dim = key[0].as_py()
        names = ("anchor_id", "slot", "vec_id", "score")
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64())
        if not data.num_rows or not anchors.num_rows:
            return pa.table({n: pa.array([], t) for n, t in zip(names, kinds)})
        by_id = data.sort_by([("vec_id", "ascending")])
        ids, rows, labels = by_id["vec_id"].to_numpy(), _matrix(by_id["v"], dim), by_id["label"].to_numpy()
        order = _near_first(_matrix(anchors["v"], dim), anchors["vec_id"].to_numpy())
        found = []
        for at in range(0, len(order), TREE):
            some = anchors.take(pa.array(order[at : at + TREE]))
            own, own_labels = some["vec_id"].to_numpy(), some["label"].to_numpy()
            search = _Search(_matrix(some["v"], dim), *windows(some), k)
            for first in range(0, len(ids), TILE):
                tile = slice(first, first + TILE)
                alike = own_labels[:, None] == labels[None, tile]
                search.see(ids[tile], rows[tile], (alike if same_label else ~alike) & (own[:, None] != ids[None, tile]))
            node, slot, vec_ids, scores = search.best
            found.append((own[node], slot, vec_ids, scores))
        return pa.table({n: pa.array(np.concatenate(c), t) for n, c, t in zip(names, zip(*found), kinds)})

    return solve


def _any_score(some: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    n = len(some)
    floors = some["floors"].to_pylist()
    low = np.array([[f[0] if f and f[0] is not None else -WIDEST] for f in floors], np.int64).reshape(n, 1)
    return low, np.full((n, 1), WIDEST)


def _score_windows(some: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """From the share LOW_PERCENT to HIGH_PERCENT of each positive's score, or from a floor known by now."""
    n = len(some)
    low, high = np.ones((n, POSITIVES), np.int64), np.zeros((n, POSITIVES), np.int64)  # no positive: nothing is inside
    for i, (scores, floors) in enumerate(zip(some["scores"].to_pylist(), some["floors"].to_pylist())):
        for j, score in enumerate(scores):
            known = floors[j] if floors and floors[j] is not None else -WIDEST
            low[i, j], high[i, j] = max(-(-LOW_PERCENT * score // 100), known), HIGH_PERCENT * score // 100
    return low, high


def labelled_vectors(vectors: DataFrame, scale: float = 256.0) -> DataFrame:
    """(vec_id, label, v) with components as floor(scale * x).

    Rows with a null id, label or vector or with a null or non-finite component are left out.
    """
    x = F.col("embedding").cast("array<double>")
    good = x.isNotNull() & ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & good)
    return rows.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.transform(x, lambda c: F.floor(c * F.lit(scale)).cast("long")).alias("v"),
    )


class _Blocks:
    """Where rows lie: labels of many rows have blocks of their own, all others share blocks by their hash.

    The labels with blocks of their own number at most rows / LEAST_ROWS.
    """

    def __init__(self, rows: DataFrame):
        spark, n = rows.sparkSession, rows.count()
        self.rows_a_block = min(MOST_ROWS, max(LEAST_ROWS, n // BLOCKS))
        counts = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= self.rows_a_block).orderBy("label").collect()
        own, first = [], 0
        for r in counts:
            blocks = -(-r["n"] // self.rows_a_block)
            own.append((r["label"], first, blocks, math.isqrt(blocks - 1) + 1))
            first += blocks
        left = n - sum(r["n"] for r in counts)
        self.first_shared, self.shared = first, -(-left // self.rows_a_block)
        self.early_shared = math.isqrt(self.shared - 1) + 1 if self.shared else 0
        self.n = first + self.shared
        self.late = any(b > e for _, _, b, e in own) or self.shared > self.early_shared
        self.own = spark.createDataFrame(own, "label long, first int, blocks int, early int")

    def placed(self, rows: DataFrame) -> DataFrame:
        """Adds ``block`` and ``early`` (it is searched first)."""
        at = F.pmod(F.xxhash64("vec_id", F.lit(11)), F.col("blocks")).cast("int")
        shared = F.pmod(F.xxhash64("label", F.lit(11)), F.lit(max(self.shared, 1))).cast("int")
        return rows.join(self.own, "label", "left").select(
            *rows.columns, F.coalesce(F.col("first") + at, F.lit(self.first_shared) + shared).alias("block"),
            F.coalesce(at < F.col("early"), shared < self.early_shared).alias("early"))

    def of_label(self, anchors: DataFrame) -> DataFrame:
        """Anchors at every block that holds rows of their label."""
        shared = F.pmod(F.xxhash64("label", F.lit(11)), F.lit(max(self.shared, 1))).cast("int") + self.first_shared
        to = F.coalesce(F.sequence(F.col("first"), F.col("first") + F.col("blocks") - 1), F.array(shared))
        return anchors.join(self.own, "label", "left").select(*anchors.columns, F.explode(to).alias("block"))

    def of_others(self, anchors: DataFrame) -> DataFrame:
        """Anchors at every block but those of their label alone."""
        others = F.sequence(F.lit(0), F.lit(max(self.n - 1, 0)))
        mine = F.coalesce((F.col("to") >= F.col("first")) & (F.col("to") < F.col("first") + F.col("blocks")), F.lit(False))
        spread = anchors.join(self.own, "label", "left").select(*anchors.columns, "first", "blocks", F.explode(others).alias("to"))
        return spread.where(~mine).select(*anchors.columns, F.col("to").alias("block"))


def _best(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k)


def _by_slot(found: DataFrame, k: int, value: Column, name: str, slots: int) -> DataFrame:
    """(vec_id, name): an array with a value for each slot of an anchor that has k rows there."""
    held = found.where(F.col("rank") == k).groupBy("anchor_id").agg(*[F.max(F.when(F.col("slot") == s, value)).alias(f"s{s}") for s in range(slots)])
    return held.select(F.col("anchor_id").alias("vec_id"), F.array(*[f"s{s}" for s in range(slots)]).alias(name))


def _searched(rows: DataFrame, anchors: DataFrame, blocks: _Blocks, parts: int, k: int, same_label: bool, slots: int) -> DataFrame:
    """(anchor_id, slot, vec_id, score, rank) of the k best rows of each anchor and window."""
    keys = ["dim", "block", "part"]
    solve = _solve(k, same_label, _any_score if same_label else _score_windows)

    def search(data: DataFrame, wanting: DataFrame) -> DataFrame:
        routed = blocks.of_label(wanting) if same_label else blocks.of_others(wanting)
        sent = data.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        found = sent.groupBy(*keys).cogroup(routed.groupBy(*keys)).applyInArrow(solve, "anchor_id long, slot int, vec_id long, score long")
        return _best(found, k)

    without = anchors.withColumn("floors", F.lit(None).cast("array<long>"))
    early = common.stored(search(rows.where("early"), without), "early")
    if not blocks.late:
        return early
    floors = _by_slot(early, k, F.col("score"), "floors", slots)
    late = search(rows.where("not early"), anchors.join(floors, "vec_id", "left"))
    return common.stored(_best(early.drop("rank").unionByName(late.drop("rank")), k), "found")


def mine(rows: DataFrame, anchors: DataFrame) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Both frames are (vec_id, label, v), anchors being rows of the table. An
    anchor's positives are the POSITIVES best other rows of its label; for
    each, the NEGATIVES best rows of other labels whose score is from
    LOW_PERCENT to HIGH_PERCENT of the positive's. Ties go to the smaller
    vec_id. Rows of the anchor's own id are no partners; of a repeated anchor
    id the smallest label and vector is the anchor, a repeated candidate counts
    each time. Vectors meet those of their own length only. An anchor without
    positives, or a positive without rows in its window, has no rows.
    """
    blocks = _Blocks(rows)
    dim = F.size("v").alias("dim")
    rows = common.stored(blocks.placed(rows.select("vec_id", "label", "v", dim)), "blocks")
    one = anchors.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("own")).select("vec_id", "own.label", "own.v")
    one = common.stored(one.withColumn("dim", F.size("v")), "anchors")
    parts = max(1, -(-one.count() // MOST_ROWS))
    one = one.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int"))
    positives = _searched(rows, one, blocks, parts, POSITIVES, True, 1).select("anchor_id", "rank", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    listed = positives.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.sort_array(F.collect_list(F.struct("rank", "positive_score"))).alias("best"))
    wanting = one.join(listed, "vec_id").select(*one.columns, F.col("best.positive_score").alias("scores"))
    negatives = _searched(rows, wanting, blocks, parts, NEGATIVES, False, POSITIVES)
    return negatives.join(positives.withColumn("slot", F.col("rank") - 1).drop("rank"), ["anchor_id", "slot"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = labelled_vectors(common.table(spark, sf_dir, "embeddings"))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = common.stored(rows.withColumn("label", moved), "vectors")
    return mine(rows, rows.where(F.col("vec_id") % 100 == 0))


OP12_SQL = """
WITH whole AS (
  SELECT vec_id::BIGINT AS vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS alike,
         list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM whole a JOIN whole c ON c.vec_id <> a.vec_id AND len(c.v) = len(a.v)
  WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id, row_number() OVER best::INTEGER AS rank, n.vec_id AS negative_id,
       p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.alike
  AND 30 * p.positive_score <= 100 * n.score AND 100 * n.score <= 90 * p.positive_score
WINDOW best AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id)
QUALIFY row_number() OVER best <= 10
"""
