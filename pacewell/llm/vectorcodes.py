"""Product codes of vectors: k-means per part with adaptive distance bounds.

Each vector is cut into parts; every part position has a codebook of entries,
moved by Lloyd rounds in whole numbers. A row keeps, for each part, its entry
with an upper bound of the distance, the b entries next to it in order with a
lower bound each, and one outer bound below the distances to all others. When
entries move, bounds give way by how far they moved. A part is looked at again
only as far down its list as its upper bound reaches, all entries only if it
passes the outer bound; what is looked at is decided by exact squared
distances in whole numbers. Where few parts reach deep into their lists, b
shrinks for the next round. The state is written once a round, so a lost
executor costs one round at most.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pacewell.llm import common
from pacewell.session import scratch_path

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096.0
MOST_NEAR = ENTRIES // 4
LEAST_NEAR = ENTRIES // 8
DEEP_SHARE = 64
FULL = np.iinfo(np.int64).max


def whole_vectors(vectors: DataFrame, scale: float = SCALE, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, label, v): components as floor(scale * x); null vectors and those with a null or non-finite component are left out.

    Numbers beyond 64 bits end at the largest or smallest of them.
    """
    x = F.col(vector).cast("array<double>")
    good = x.isNotNull() & ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    whole = F.transform(x, lambda c: F.floor(c * F.lit(scale)).cast("long"))
    return vectors.where(good).select(F.col(key).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"), whole.alias("v"))


def _squares(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows [n, w] to entries [n or 1, m, w]; Python integers where 64 bits might not do."""
    reach = max(int(np.abs(a).max(initial=0)) if a.dtype == object or not (a == np.iinfo(np.int64).min).any() else 1 << 63 for a in (x, entries))
    if 4 * reach * reach * max(x.shape[1], 1) >= 1 << 63:
        x, entries = x.astype(object), entries.astype(object)
    apart = x[:, None, :] - entries
    return (apart * apart).sum(axis=2)


def _below(d) -> np.ndarray:
    """As 32-bit floats that are not above ``d``; an infinite bound stays."""
    return np.nextafter(np.asarray(d, np.float64).astype(np.float32), np.float32(-np.inf), where=np.isfinite(d), out=np.full(np.shape(d), np.inf, np.float32))


def _above(d) -> np.ndarray:
    return np.nextafter(np.asarray(d, np.float64).astype(np.float32), np.float32(np.inf))


def _roots(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64))


def _part(near: int) -> list:
    return [("entry", "u1"), ("asked", "u1"), ("upper", "<f4"), ("near", "u1", (near,)), ("low", "<f4", (near,)), ("outer", "<f4")]


@dataclass(frozen=True)
class Codebooks:
    """Entries [part, entry, position] of one vector length, how far each moved last, and b before and from now on."""

    entries: np.ndarray
    moved: np.ndarray
    near_before: tuple[int, ...]
    near: tuple[int, ...]

    def layout(self, before: bool = False) -> np.dtype:
        return np.dtype([(f"p{i}", _part(b)) for i, b in enumerate(self.near_before if before else self.near)])

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def start(self, x: np.ndarray) -> np.ndarray:
        """State of rows [n, part, position] that have none."""
        out = np.zeros(len(x), self.layout())
        for p, b in enumerate(self.near):
            self._search(x[:, p], p, b, out[f"p{p}"], np.arange(len(x)))
            out[f"p{p}"]["asked"] = b + 1
        return out

    def _search(self, x: np.ndarray, p: int, b: int, out: np.ndarray, rows: np.ndarray) -> None:
        """All entries of one part for some rows."""
        if not len(rows):
            return
        squares = _squares(x[rows], self.entries[None, p])
        order = np.argsort(squares, axis=1, kind="stable")  # ties to the lower index
        far = _roots(np.take_along_axis(squares, order, axis=1))
        out["entry"][rows], out["near"][rows] = order[:, 0], order[:, 1 : b + 1]
        out["upper"][rows], out["low"][rows] = _above(far[:, 0]), _below(far[:, 1 : b + 1])
        out["outer"][rows] = _below(far[:, b + 1]) if far.shape[1] > b + 1 else np.inf

    def follow(self, x: np.ndarray, state: np.ndarray) -> np.ndarray:
        """State after the entries moved."""
        out = np.zeros(len(x), self.layout())
        for p, b in enumerate(self.near):
            was, now, moved = state[f"p{p}"], out[f"p{p}"], self.moved[p]
            low = was["low"].astype(np.float64) - moved[was["near"]]
            outer = was["outer"].astype(np.float64) - moved.max(initial=0.0)
            # Ascending again, so that what holds for one holds for all behind it; a shorter list ends in the new outer bound.
            bounds = np.concatenate([low, outer[:, None]], axis=1)
            bounds = _below(np.minimum.accumulate(bounds[:, ::-1], axis=1)[:, ::-1])[:, : b + 1]
            entry, near = was["entry"].copy(), was["near"][:, :b].copy()
            upper = _above(was["upper"].astype(np.float64) + moved[entry])
            rows = np.flatnonzero(upper >= bounds[:, 0])
            upper[rows] = _above(_roots(_squares(x[rows, p], self.entries[p][entry[rows]][:, None])[:, 0]))
            asked = (upper[:, None] >= bounds).sum(axis=1)
            now["entry"], now["near"], now["upper"], now["low"], now["outer"] = entry, near, upper, bounds[:, :b], bounds[:, b]
            for depth in range(1, b + 1):
                rows = np.flatnonzero(asked == depth)
                if not len(rows):
                    continue
                some = np.sort(np.concatenate([entry[rows, None], near[rows, :depth]], axis=1), axis=1)
                squares = _squares(x[rows, p], self.entries[p][some])
                order = np.argsort(squares, axis=1, kind="stable")
                far, some = _roots(np.take_along_axis(squares, order, axis=1)), np.take_along_axis(some, order, axis=1)
                now["entry"][rows], now["upper"][rows] = some[:, 0], _above(far[:, 0])
                now["near"][rows[:, None], np.arange(depth)] = some[:, 1:]
                now["low"][rows[:, None], np.arange(depth)] = np.minimum(_below(far[:, 1:]), bounds[rows, depth, None])
            self._search(x[:, p], p, b, now, np.flatnonzero(asked == b + 1))
            now["asked"] = asked
        return out

    def errors(self, x: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Squared distance to the codes' entries, summed over parts; at most the largest 64-bit number."""
        found = sum(_squares(x[:, p], self.entries[p][codes[:, p]][:, None])[:, 0] for p in range(x.shape[1]))
        return np.array([min(int(e), FULL) for e in found], np.int64) if found.dtype == object else found

    def next(self, sums: dict, counts: dict, asked: dict) -> Codebooks:
        """Entries moved to the floor of their parts' means, unused ones left; b by how deep the lists were asked."""
        entries = self.entries.copy()
        for (p, e), n in counts.items():
            entries[p, e] = [sums[p, e, i] // n for i in range(entries.shape[2])]
        old, new = self.entries.astype(np.float64), entries.astype(np.float64)
        moved = np.sqrt(((new - old) ** 2).sum(axis=2)) * (1 + 1e-9)
        near = []
        for p, b in enumerate(self.near):
            depths = np.array([asked.get((p, d), 0) for d in range(b + 2)])
            shorter = [c for c in range(min(LEAST_NEAR, b), b) if depths[c + 1 : b + 1].sum() * DEEP_SHARE <= depths.sum()]
            near.append(min(shorter, default=b))
        return Codebooks(entries, moved, self.near, tuple(near))


def _parts(column: pa.Array, at: np.ndarray, dim: int) -> np.ndarray:
    return column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), PARTS, dim // PARTS)


def _by_length(batch: pa.RecordBatch, books: dict[int, Codebooks]):
    sizes = batch.column("v").value_lengths().to_numpy(zero_copy_only=False)
    for dim in np.unique(sizes).tolist():
        if dim in books:
            yield dim, np.flatnonzero(sizes == dim)


_ROWS = "vec_id long, label string, v array<long>, state binary"


def _assigned(rows: DataFrame, books: dict[int, Codebooks], first: bool) -> DataFrame:
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("vec_id", pa.int64()), ("label", pa.string()), ("v", pa.list_(pa.int64())), ("state", pa.binary())])
        for batch in batches:
            for dim, at in _by_length(batch, books):
                book, x = books[dim], _parts(batch.column("v"), at, dim)
                if first:
                    state = book.start(x)
                else:
                    held = b"".join(batch.column("state").take(pa.array(at)).to_pylist())
                    state = book.follow(x, np.frombuffer(held, book.layout(before=True)))
                raw, width = state.tobytes(), state.dtype.itemsize
                own = batch.take(pa.array(at))
                yield common.record_batch(schema, *(own.column(c) for c in ("vec_id", "label", "v")), [raw[i : i + width] for i in range(0, len(raw), width)])

    return rows.mapInArrow(assign, _ROWS)


def _tallies(rows: DataFrame, books: dict[int, Codebooks]) -> DataFrame:
    """(dim, kind, part, entry, position, total) over all rows: sums of components, counts, and how deep lists were asked. Tasks add up first."""

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple, int] = {}

        def add(key, n):
            if n:
                total[key] = total.get(key, 0) + int(n)

        for batch in batches:
            for dim, at in _by_length(batch, books):
                book, x = books[dim], _parts(batch.column("v"), at, dim)
                state = np.frombuffer(b"".join(batch.column("state").take(pa.array(at)).to_pylist()), book.layout())
                wide = x.astype(object) if int(np.abs(x.astype(np.float64)).max(initial=0)) * len(x) >= 1 << 62 else x
                for p in range(PARTS):
                    entry = state[f"p{p}"]["entry"]
                    for e in np.unique(entry).tolist():
                        mine = wide[entry == e, p]
                        add((dim, "count", p, e, 0), len(mine))
                        for i, s in enumerate(mine.sum(axis=0).tolist()):
                            add((dim, "sum", p, e, i), s)
                    for d, n in enumerate(np.bincount(state[f"p{p}"]["asked"]).tolist()):
                        add((dim, "asked", p, d, 0), n)
        from decimal import Decimal

        schema = pa.schema([("dim", pa.int32()), ("kind", pa.string()), ("part", pa.int32()), ("entry", pa.int32()), ("position", pa.int32()), ("total", pa.decimal128(38))])
        yield common.record_batch(schema, *(zip(*total) if total else [[]] * 5), [Decimal(n) for n in total.values()])

    found = rows.mapInArrow(tally, "dim int, kind string, part int, entry int, position int, total decimal(38,0)")
    return found.groupBy("dim", "kind", "part", "entry", "position").agg(F.sum("total").cast("decimal(38,0)").alias("total"))


def _first_books(rows: DataFrame) -> dict[int, Codebooks]:
    """The parts of the rows with the smallest ids (then vectors), for each vector length."""
    lengths = [r["n"] for r in rows.select(F.size("v").alias("n")).distinct().collect() if r["n"] and r["n"] % PARTS == 0]
    books = {}
    for dim in lengths:
        first = rows.where(F.size("v") == dim).orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(ENTRIES).collect()
        entries = np.array([r["v"] for r in first], np.int64).reshape(len(first), PARTS, dim // PARTS).swapaxes(0, 1)
        near = (min(MOST_NEAR, len(first) - 1),) * PARTS
        books[dim] = Codebooks(entries, np.zeros(entries.shape[:2]), near, near)
    return books


class _Rounds:
    """States of the rows, one written table a round; the one before the last is removed."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def write(self, df: DataFrame) -> DataFrame:
        path = scratch_path(self.spark, "codes")
        df.write.parquet(path)
        self.paths.append(path)
        if len(self.paths) > 2:
            old = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop(0))
            old.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(old, True)
        return self.spark.read.schema(df.schema).parquet(path)


def learn(rows: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, dict[int, Codebooks]]:
    """Rows (vec_id, label, v) with their state after ``rounds`` rounds and a last assignment, and the codebooks.

    Vectors of each length have codebooks of their own; lengths that PARTS does
    not divide have none, and their rows no code. Fewer rows than ENTRIES make
    as many entries. Null ids come last in the order, repeated rows count each.
    An empty table has no codebooks and no rows.
    """
    written = _Rounds(rows.sparkSession)
    rows = written.write(rows)
    books = _first_books(rows)
    held = written.write(_assigned(rows, books, first=True))
    for _ in range(rounds):
        # At most 8 x 16 entries of a vector's length, whatever the number of rows.
        totals: dict[int, dict[str, dict]] = {d: {"sum": {}, "count": {}, "asked": {}} for d in books}
        for r in _tallies(held, books).collect():
            place = (r["part"], r["entry"], r["position"]) if r["kind"] == "sum" else (r["part"], r["entry"])
            totals[r["dim"]][r["kind"]][place] = int(r["total"])
        for dim, book in books.items():
            own = totals[dim]
            sums = {(p, e, i): own["sum"].get((p, e, i), 0) for p, e in own["count"] for i in range(dim // PARTS)}
            books[dim] = book.next(sums, own["count"], own["asked"])
        held = written.write(_assigned(held, books, first=False))
    return held, books


def codes(held: DataFrame, books: dict[int, Codebooks]) -> DataFrame:
    """(vec_id, label, code, error, codebooks_sha256) of rows with their state: two hex digits a part, squared distance to the code."""
    names = {d: b.sha256() for d, b in books.items()}

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("vec_id", pa.int64()), ("label", pa.string()), ("code", pa.string()), ("error", pa.int64()), ("codebooks_sha256", pa.string())])
        for batch in batches:
            for dim, at in _by_length(batch, books):
                book, own = books[dim], batch.take(pa.array(at))
                state = np.frombuffer(b"".join(own.column("state").to_pylist()), book.layout())
                found = np.stack([state[f"p{p}"]["entry"] for p in range(PARTS)], axis=1)
                error = book.errors(_parts(batch.column("v"), at, dim), found)
                yield common.record_batch(schema, own.column("vec_id"), own.column("label"), [bytes(r).hex() for r in found], error, [names[dim]] * len(at))

    return held.mapInArrow(read, "vec_id long, label string, code string, error long, codebooks_sha256 string")


def with_label_errors(coded: DataFrame) -> DataFrame:
    """Adds label_error, the error of all rows of equal label (nulls together); one sum a label is joined back."""
    sums = coded.groupBy(F.col("label").alias("of")).agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("total"))
    label_error = F.least("total", F.lit(FULL).cast("decimal(38,0)")).cast("long")
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of")), "left").withColumn("label_error", label_error).drop("of", "total")


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = codes(*learn(whole_vectors(common.table(spark, sf_dir, "embeddings"))))
    return with_label_errors(coded).select("vec_id", "code", "error", "label_error", "codebooks_sha256")
