"""Exact top-k by integer inner product, as a Voronoi join.

Vectors are grouped by their nearest pivot; a cell is summed up by its pivot,
radius and count. A query q scores q.p + q.(x - p) <= q.p + |q| r in a cell,
and its k-th best score is at least what the pivots themselves (which are
rows) or the cells' lower bounds give. A query is sent only to cells whose
upper bound reaches that, and is solved locally there. The replicated side is
the query side, a fiftieth of the rows; each candidate moves once per block of
queries. Large cells are cut into blocks of bounded size by hash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pacewell.llm import common

PIVOTS = 64
K = 5
MOST_ROWS = 1 << 15
LEAST_ROWS = 1 << 9
BLOCKS = 256
TILE = 1 << 20


def integers(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", scale: float = 256.0) -> DataFrame:
    """(vec_id, v): each component x as floor(scale * x).

    Rows without id, null vectors and vectors with a null or non-finite component are left out.
    """
    x = F.col(vector).cast("array<double>")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = vectors.where(F.col(key).isNotNull() & x.isNotNull() & ~bad)
    return rows.select(F.col(key).cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c * F.lit(scale)).cast("long")).alias("v"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers: in floating point while all sums stay below 2^53, else in wrapping 64-bit."""
    reach = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if reach < 2.0**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return np.einsum("id,jd->ij", a, b)


@dataclass(frozen=True)
class Cells:
    """Pivots of one dimension with their ids, and the cells' radii, counts and blocks (0 where empty)."""

    ids: np.ndarray
    pivots: np.ndarray
    radii: np.ndarray
    counts: np.ndarray
    blocks: np.ndarray

    def distances(self, rows: np.ndarray) -> np.ndarray:
        a, p = rows.astype(np.float64), self.pivots.astype(np.float64)
        squares = (a * a).sum(axis=1)[:, None] + (p * p).sum(axis=1)[None, :] - 2.0 * (a @ p.T)
        return np.sqrt(np.maximum(squares, 0.0))

    def reachable(self, ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
        """Which cells may hold one of the k best scores of each query."""
        a, p = rows.astype(np.float64), self.pivots.astype(np.float64)
        centre = a @ p.T
        slack = 1.0 + 1e-9 * np.abs(centre)
        spread = np.sqrt((a * a).sum(axis=1))[:, None] * self.radii[None, :]
        low = np.where(self.counts > 0, centre - spread - slack, -np.inf)
        order = np.argsort(-low, axis=1, kind="stable")
        enough = (np.cumsum(self.counts[order], axis=1) >= k + 1).argmax(axis=1)
        every = np.arange(len(rows))
        floor = np.where(self.counts.sum() > k, low[every, order[every, enough]], -np.inf)
        known = np.where((self.ids[None, :] >= 0) & (self.ids[None, :] != ids[:, None]), centre - slack, -np.inf)
        if known.shape[1] >= k:
            floor = np.maximum(floor, np.sort(known, axis=1)[:, -k])
        return (self.counts > 0) & (centre + spread + slack >= floor[:, None])


def _assigned(vectors: DataFrame, pivots: dict[int, Cells]) -> DataFrame:
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("vec_id", pa.int64()), ("v", pa.list_(pa.int64())), ("dim", pa.int32()), ("cell", pa.int32()), ("distance", pa.float64())])
        for batch in batches:
            sizes = np.asarray([len(x) for x in batch.column("v")])
            for dim in np.unique(sizes).tolist():
                at = pa.array(np.flatnonzero(sizes == dim))
                ids, column = batch.column("vec_id").take(at), batch.column("v").take(at)
                cells = pivots.get(dim) or _no_pivots(dim)
                far = cells.distances(_matrix(column, dim))
                cell = far.argmin(axis=1)
                # The radius covers rounding of the distance.
                yield common.record_batch(schema, ids, column, np.full(len(at), dim), cell, far[np.arange(len(cell)), cell] * (1 + 1e-9) + 1e-3)

    return vectors.mapInArrow(assign, "vec_id long, v array<long>, dim int, cell int, distance double")


def _no_pivots(dim: int) -> Cells:
    return Cells(np.full(1, -1), np.zeros((1, dim), np.int64), np.zeros(1), np.zeros(1, np.int64), np.zeros(1, np.int64))


def _solve(k: int):
    def solve(key, data: pa.Table, queries: pa.Table) -> pa.Table:
        dim, best = key[0].as_py(), []
        order = np.argsort(data["vec_id"].to_numpy(), kind="stable")
        ids, rows = data["vec_id"].to_numpy()[order], _matrix(data["v"], dim)[order]
        query_ids, wanted = queries["vec_id"].to_numpy(), _matrix(queries["v"], dim)
        step = max(1, TILE // max(len(ids), 1))
        keep = min(k, len(ids))
        for first in range(0, len(query_ids) if keep else 0, step):
            own, scores = query_ids[first : first + step], _products(wanted[first : first + step], rows)
            self_ = ids[None, :] == own[:, None]
            if float(np.abs(scores).max(initial=0)) * (len(ids) + 1) < 2.0**62:
                ranked = scores * len(ids) + (len(ids) - 1 - np.arange(len(ids)))  # ties to the smaller id
                ranked[self_] = np.iinfo(np.int64).min
                top = np.argpartition(-(ranked + 1), keep - 1, axis=1)[:, :keep]
            else:
                top = np.stack([np.lexsort((np.arange(len(ids)), -s.astype(object), m))[:keep] for s, m in zip(scores, self_)])
            at = np.repeat(np.arange(len(own)), keep), top.ravel()
            mine = ~self_[at]
            best.append((own[at[0]][mine], ids[at[1]][mine], scores[at][mine]))
        columns = [np.concatenate(c) for c in zip(*best)] if best else [np.zeros(0, np.int64)] * 3
        return pa.table(dict(zip(("query_id", "vec_id", "score"), columns)))

    return solve


def nearest(vectors: DataFrame, queries: DataFrame, k: int = K, n_pivots: int = PIVOTS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of each query with rows of other ids.

    Both frames are (vec_id, v). Ties go to the smaller vec_id. A query meets
    only vectors of its own length; repeated rows of a candidate count each, a
    repeated query id is one query with the smallest of its vectors. Without
    candidates or queries there are no rows.
    """
    spark = vectors.sparkSession
    vectors = common.stored(vectors, "vectors")
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(n_pivots).collect()
    by_dim: dict[int, list] = {}
    for r in sample:
        by_dim.setdefault(len(r["v"]), []).append(r)
    pivots = {d: Cells(np.array([r["vec_id"] for r in rs]), np.array([r["v"] for r in rs], np.int64).reshape(len(rs), d), *[np.zeros(len(rs))] * 3) for d, rs in by_dim.items()}
    assigned = common.stored(_assigned(vectors, pivots), "cells")
    queries = common.stored(queries.groupBy("vec_id").agg(F.min("v").alias("v")), "queries")
    n_queries = queries.count()
    parts = max(1, -(-n_queries // MOST_ROWS))
    # One row per pivot of each vector length.
    summary = assigned.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("n"), F.max("distance").alias("radius")).collect()
    rows_a_block = min(MOST_ROWS, max(LEAST_ROWS, sum(r["n"] for r in summary) // BLOCKS))
    cells = {}
    for dim in {r["dim"] for r in summary}:
        have = pivots.get(dim) or _no_pivots(dim)
        radii, counts = np.zeros(len(have.ids)), np.zeros(len(have.ids), np.int64)
        for r in summary:
            if r["dim"] == dim:
                radii[r["cell"]], counts[r["cell"]] = r["radius"], r["n"]
        cells[dim] = Cells(have.ids, have.pivots, radii, counts, -(-counts // rows_a_block))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("vec_id", pa.int64()), ("v", pa.list_(pa.int64())), ("dim", pa.int32()), ("cell", pa.int32()), ("block", pa.int32()), ("part", pa.int32())])
        for batch in batches:
            sizes = np.asarray([len(x) for x in batch.column("v")])
            for dim in np.unique(sizes).tolist():
                if dim not in cells:
                    continue
                known, where = cells[dim], np.flatnonzero(sizes == dim)
                for some in np.array_split(where, -(-len(where) // 1024)):
                    ids, column = batch.column("vec_id").take(pa.array(some)), batch.column("v").take(pa.array(some))
                    parts_of = batch.column("part").take(pa.array(some)).to_numpy()
                    to = known.reachable(ids.to_numpy(), _matrix(column, dim), k)
                    for cell in np.flatnonzero(to.any(axis=0)).tolist():
                        at = np.flatnonzero(to[:, cell])
                        for block in range(int(known.blocks[cell])):
                            n = len(at)
                            yield common.record_batch(schema, ids.take(pa.array(at)), column.take(pa.array(at)), np.full(n, dim), np.full(n, cell), np.full(n, block), parts_of[at])

    part = F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int").alias("part")
    routed = queries.select("vec_id", "v", part).mapInArrow(route, "vec_id long, v array<long>, dim int, cell int, block int, part int")
    blocks = spark.createDataFrame(
        [(d, c, int(n)) for d, x in cells.items() for c, n in enumerate(x.blocks.tolist()) if n], "dim int, cell int, blocks int"
    )
    data = assigned.join(blocks, ["dim", "cell"]).select(
        "vec_id", "v", "dim", "cell", F.pmod(F.xxhash64("vec_id", F.lit(7)), F.col("blocks")).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"),
    )
    keys = ["dim", "cell", "block", "part"]
    found = data.groupBy(*keys).cogroup(routed.groupBy(*keys)).applyInArrow(_solve(k), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = integers(common.table(spark, sf_dir, "embeddings"))
    return nearest(vectors, vectors.where(F.col("vec_id") % 50 == 0))


OP6_SQL = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM whole q JOIN whole c ON c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
  WHERE q.vec_id % 50 = 0
)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
) WHERE rank <= 5
"""
