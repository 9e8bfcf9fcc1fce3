"""Near-duplicate documents by SetSketch registers.

A register holds the logarithm, to a base just above one, of the smallest
exponential hash of a document's shingles, cut to whole steps. Registers of a
union are the larger ones, and two documents agree in a register about as
often as their sets overlap.

Documents with equal shingle sets are one class. Bands of registers put
classes into buckets. In each bucket every member is compared with one hub by
the joint likelihood of their registers: clearly similar ones are joined to
it, and while a bucket has members that are far from its hub, these and all
that are not very close to the hub meet again with a new hub. As Jaccard
distance is a metric, two linked classes are joined through hubs in any case,
and no pairs within a bucket are listed. The clusters found so are then
verified on full sets; a cluster too large for one task is dealt into blocks
that meet pairwise.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pacewell.llm import common, textbytes
from pacewell.llm.components import components

REGISTERS = 128
BASE = 1.001
RATE = 20.0
TOP = 65534
BANDS, BAND_WIDTH = 48, 6
BLOCK_DOCS, BLOCK_SHINGLES, BLOCK_MEMBERS = 1024, 1 << 20, 2048
COLUMNS = 4096

_rng = np.random.default_rng(7)
_FACTORS = _rng.integers(0, 1 << 63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_DESIGN = np.stack([_rng.choice(REGISTERS, BAND_WIDTH, replace=False) for _ in range(BANDS)])
_ODD = np.uint64(0xD6E8FEB86659FD93)


@dataclass(frozen=True)
class Likeness:
    """Words to a shingle, and the least Jaccard similarity as a fraction part / whole."""

    words: int = 5
    part: int = 80
    whole: int = 100

    @property
    def share(self) -> float:
        return self.part / self.whole


def shingle_sets(texts: pa.Array, words: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, distinct shingle hashes of the rows in a row, their bounds) for runs of rows.

    Words are runs of characters that are no ASCII white space, A-Z lower-cased.
    A text with fewer words than a shingle takes has its whole sequence as one;
    a null text or one without words has none. Hashes of a row are sorted.
    """
    for first, end, data, offsets in textbytes.chunks(texts):
        data = textbytes.LOWER[data]
        starts, ends, rows = textbytes.word_spans(data, offsets)
        keys = textbytes.hash_spans(data, starts, ends)
        counts = np.bincount(rows, minlength=end - first)
        n = max(len(keys) - words + 1, 0)
        mixed = np.zeros(n, np.uint64)
        for at in range(words):
            mixed = textbytes.mix(mixed * _ODD + keys[at : at + n])
        whole = rows[:n] == rows[words - 1 : words - 1 + n]
        mixed, owner = mixed[whole], rows[:n][whole]
        short = np.flatnonzero((counts > 0) & (counts < words))
        if len(short):
            bounds = np.concatenate([[0], np.cumsum(counts)])
            extra = np.zeros(len(short), np.uint64)
            for i, row in enumerate(short.tolist()):
                value = np.full(1, counts[row] + 1, np.uint64)
                for key in keys[bounds[row] : bounds[row + 1]]:
                    value = textbytes.mix(value * _ODD + key)
                extra[i] = value[0]
            mixed, owner = np.concatenate([mixed, extra]), np.concatenate([owner, short])
        order = np.lexsort((mixed, owner))
        mixed, owner = mixed[order], owner[order]
        fresh = np.ones(len(mixed), bool)
        fresh[1:] = (mixed[1:] != mixed[:-1]) | (owner[1:] != owner[:-1])
        mixed, owner = mixed[fresh], owner[fresh]
        yield first, mixed, np.searchsorted(owner, np.arange(end - first + 1))


def registers(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One row of registers per set; empty sets have zeros."""
    full = np.flatnonzero(np.diff(bounds))
    out = np.zeros((len(bounds) - 1, REGISTERS), np.uint16)
    if not len(full):
        return out
    least = np.stack([np.minimum.reduceat(hashes * factor, bounds[full]) for factor in _FACTORS], axis=1)
    exponential = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64) / RATE
    steps = np.floor(1.0 - np.log(np.maximum(exponential, 1e-300)) / np.log(BASE))
    out[full] = np.clip(steps, 0, TOP + 1).astype(np.uint16)
    return out


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def at_least(share: float, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Whether the likeliest Jaccard similarity of each pair of register rows is ``share`` or more.

    The log-likelihood given both set sizes is concave in the similarity, so
    its slope at ``share`` decides.
    """
    above, below = (a > b).sum(axis=-1), (a < b).sum(axis=-1)
    equal = REGISTERS - above - below
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    c = (BASE - 1.0) / BASE
    possible = share * np.maximum(u, v) <= np.minimum(u, v)
    x, y = np.maximum(u - v * share, 1e-12), np.maximum(v - u * share, 1e-12)
    p, q = -np.log1p(-c * x) / np.log(BASE), -np.log1p(-c * y) / np.log(BASE)
    dp, dq = -v * c / (1 - c * x) / np.log(BASE), -u * c / (1 - c * y) / np.log(BASE)
    slope = above * dp / p + below * dq / q - equal * (dp + dq) / np.maximum(1 - p - q, 1e-12)
    return possible & (slope >= 0)


def _signatures(hashes: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit sums over each set that do not depend on order."""
    out = []
    for salt in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
        run = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(textbytes.mix(hashes ^ np.uint64(salt)), out=run[1:], dtype=np.uint64)
        out.append((run[bounds[1:]] - run[bounds[:-1]]).view(np.int64))
    return out


def _placed(docs: DataFrame) -> DataFrame:
    """doc_id, text, and a key by which a text is found again: the doc_id, or the text's hash where that is null."""
    doc_id, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    key = F.xxhash64(text)
    return docs.select(doc_id.alias("doc_id"), F.coalesce(doc_id, key).alias("place"), key.alias("text_key"), text.alias("text"))


_SKETCH = "rid long, doc_id long, place long, text_key long, n_shingles long, sign_a long, sign_b long, registers binary"


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """One row per document: an own row id, set size, two order-free signatures of the set, and the registers."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"registers": pa.binary()}
        schema = pa.schema([(c, kinds.get(c, pa.int64())) for c in ("rid", "doc_id", "place", "text_key", "n_shingles", "sign_a", "sign_b", "registers")])
        rid = TaskContext.get().partitionId() << 40
        for batch in batches:
            for first, hashes, bounds in shingle_sets(batch.column("text"), words):
                n = len(bounds) - 1
                own, rows = (batch.column(c).slice(first, n) for c in ("doc_id", "place", "text_key")), registers(hashes, bounds)
                yield common.record_batch(schema, np.arange(rid, rid + n), *own, np.diff(bounds), *_signatures(hashes, bounds), [r.tobytes() for r in rows])
                rid += n

    return _placed(docs).mapInArrow(sketch, _SKETCH)


def _rows_of(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), REGISTERS)


def _band_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("key", pa.int64()), ("rid", pa.int64())])
    for batch in batches:
        rows, rids = _rows_of(batch.column("registers")).astype(np.uint64), batch.column("rid").to_numpy()
        for band, places in enumerate(_DESIGN):
            key = np.full(len(rows), band + 1, np.uint64)
            for place in places:
                key = textbytes.mix(key * _ODD + rows[:, place])
            yield common.record_batch(schema, key.view(np.int64), rids)


def _levels(low: float, high: float):
    def levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("rid", pa.int64()), ("hub", pa.int64()), ("level", pa.int32())])
        for batch in batches:
            for start in range(0, len(batch), 2048):
                some = batch.slice(start, 2048)
                pair = _rows_of(some.column("registers")), _rows_of(some.column("hub_registers"))
                sizes = some.column("n_shingles").to_numpy().astype(float), some.column("hub_n").to_numpy().astype(float)
                level = at_least(low, *pair, *sizes).astype(np.int32) + at_least(high, *pair, *sizes)
                yield common.record_batch(schema, some.column("rid"), some.column("hub"), level)

    return levels


def _leaders(low: float, high: float):
    def join(rids: list[int], sizes: np.ndarray, rows: np.ndarray) -> list[tuple[int, int]]:
        """Hubs of one bucket in turn; the first member is one that no hub has been near to yet.

        Of the edges only those come out that join what is not joined yet.
        """
        edges, left, label = [], np.arange(len(rids)), np.arange(len(rids))
        hub = 0
        while len(left) > 1:
            others = left[left != hub]
            pair = rows[others], rows[hub][None, :]
            near = at_least(low, *pair, sizes[others], sizes[hub])
            close = near & at_least(high, *pair, sizes[others], sizes[hub])
            found = label[others[near]]
            _, new = np.unique(found[found != label[hub]], return_index=True)
            edges += [(rids[i], rids[hub]) for i in others[near][found != label[hub]][new].tolist()]
            label[np.isin(label, found)] = label[hub]
            if near.all():
                break
            hub = int(others[~near][0])
            left = others[~close]
        return edges

    def leaders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        key, rids, sizes, rows = None, [], [], []

        def solved():
            edges = join(rids, np.array(sizes, float), np.frombuffer(b"".join(rows), np.uint16).reshape(len(rows), REGISTERS))
            return common.record_batch(schema, [i for i, _ in edges], [j for _, j in edges])

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("key", "block_a", "block_b", "rid", "n_shingles", "registers"))
            for k, i, j, rid, n, row in zip(*columns):
                if (k, i, j) != key:
                    if len(rids) > 1:
                        yield solved()
                    key, rids, sizes, rows = (k, i, j), [], [], []
                rids.append(rid)
                sizes.append(n)
                rows.append(row)
        if len(rids) > 1:
            yield solved()

    return leaders


def _in_blocks(rows: DataFrame, key: str, blocks: DataFrame) -> DataFrame:
    """Rows with (block_a, block_b): a key's rows are dealt into its number of blocks, and every two blocks meet."""
    rows = rows.join(blocks.select(key, "blocks"), key).withColumn("block", F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.where((F.col("blocks") == 1) | (F.col("other") != F.col("block")))
    return rows.withColumns({"block_a": F.least("block", "other"), "block_b": F.greatest("block", "other")}).drop("block", "other", "blocks")


def candidate_edges(classes: DataFrame, like: Likeness) -> DataFrame:
    """Pairs (a, b) of classes that the likelihood puts near each other, enough to join all linked ones.

    Every member of a bucket meets the bucket's first hub in a join. Only
    buckets with members far from it go on, with further hubs, in one task a
    bucket; those of more than BLOCK_MEMBERS rows are dealt into blocks that meet pairwise.
    """
    low, high = max(like.share - 0.30, 0.05), min(like.share + 0.05, 1.0)
    bands = common.stored(classes.select("rid", "registers").mapInArrow(_band_rows, "key long, rid long"), "bands")
    hubs = bands.groupBy("key").agg(F.min("rid").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1").select("key", "hub")
    active = common.stored(bands.join(hubs, "key").where("rid <> hub"), "buckets")
    own = classes.select("rid", "n_shingles", "registers")
    theirs = own.select(F.col("rid").alias("hub"), F.col("n_shingles").alias("hub_n"), F.col("registers").alias("hub_registers"))
    pairs = active.select("rid", "hub").distinct().join(own, "rid").join(theirs, "hub")
    levels = common.stored(pairs.mapInArrow(_levels(low, high), "rid long, hub long, level int"), "levels")
    rest = common.stored(active.join(levels, ["rid", "hub"]).where("level < 2").select("key", "rid", "level"), "buckets")
    sizes = rest.groupBy("key").agg(F.min("level").alias("least"), F.ceil(F.count(F.lit(1)) / BLOCK_MEMBERS).cast("int").alias("blocks"))
    # A bucket that is small here is one key of many; its rows carry their registers once each.
    placed = _in_blocks(rest, "key", sizes.where("least = 0")).join(own, "rid")
    group = "key", "block_a", "block_b"
    placed = placed.repartition(*group).sortWithinPartitions(*group, "level", "rid").select(*group, "rid", "n_shingles", "registers")
    more = placed.mapInArrow(_leaders(low, high), "a long, b long").distinct()
    return levels.where("level > 0").select(F.col("rid").alias("a"), F.col("hub").alias("b")).unionByName(more)


def _linked(hashes: np.ndarray, bounds: np.ndarray, like: Likeness) -> list[tuple[int, int]]:
    """Edges that join all linked sets of a group, from exact intersections."""
    n, sizes = len(bounds) - 1, np.diff(bounds)
    owner = np.repeat(np.arange(n), sizes)
    order = np.argsort(hashes, kind="stable")
    values, owner = hashes[order], owner[order]
    fresh = np.ones(len(values), bool)
    fresh[1:] = values[1:] != values[:-1]
    place = np.cumsum(fresh) - 1
    shared = np.bincount(place) > 1  # shingles of one document alone are in no intersection
    keep = shared[place]
    place, owner = (np.cumsum(shared) - 1)[place[keep]], owner[keep]
    common_ = np.zeros((n, n), np.float32)
    for first in range(0, int(shared.sum()), COLUMNS):
        a, b = np.searchsorted(place, [first, first + COLUMNS])
        block = np.zeros((n, COLUMNS), np.float32)
        block[owner[a:b], place[a:b] - first] = 1
        common_ += block @ block.T
    both = common_.astype(np.int64)
    union = sizes[:, None] + sizes[None, :] - both
    near = (like.whole * both >= like.part * union) & (union > 0)
    label = np.arange(n)
    while True:
        now = np.where(near, label[None, :], n).min(axis=1, initial=n)
        now = np.minimum(now, label)
        now = now[now]
        if np.array_equal(now, label):
            return [(i, int(x)) for i, x in enumerate(label) if i != x]
        label = now


def _verify(like: Likeness):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
        key, rids, sets = None, [], []

        def solved():
            bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
            edges = _linked(np.concatenate(sets), bounds, like) if len(sets) > 1 else []
            return common.record_batch(schema, [rids[i] for i, _ in edges], [rids[j] for _, j in edges])

        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("cluster", "block_a", "block_b"))))
            own, signs = batch.column("rid").to_pylist(), list(zip(batch.column("sign_a").to_pylist(), batch.column("sign_b").to_pylist()))
            for first, hashes, bounds in shingle_sets(batch.column("text"), like.words):
                found = list(zip(*(x.tolist() for x in _signatures(hashes, bounds))))
                for at in range(len(bounds) - 1):
                    if found[at] != signs[first + at]:  # another text under the same doc_id
                        continue
                    if keys[first + at] != key:
                        if len(rids) > 1:
                            yield solved()
                        key, rids, sets = keys[first + at], [], []
                    rids.append(own[first + at])
                    sets.append(hashes[bounds[at] : bounds[at + 1]].copy())
        if len(rids) > 1:
            yield solved()

    return verify


def verified_edges(docs: DataFrame, sketched: DataFrame, clusters: DataFrame, like: Likeness) -> DataFrame:
    """Pairs (a, b) of row ids with linked full sets, enough to join each component within the clusters.

    ``clusters`` is (node, root). A cluster of more than BLOCK_DOCS documents or
    BLOCK_SHINGLES shingles is dealt into blocks by hash; every two blocks meet
    in one group, so a group's size is bounded and no pair is missed.
    """
    nodes = clusters.select(F.col("node").alias("rid"), F.col("root").alias("cluster"))
    nodes = nodes.unionByName(clusters.select(F.col("root").alias("rid"), F.col("root").alias("cluster")).distinct())
    nodes = nodes.join(sketched.select("rid", "place", "n_shingles", "sign_a", "sign_b"), "rid")
    sizes = nodes.groupBy("cluster").agg(F.count(F.lit(1)).alias("docs"), F.sum("n_shingles").alias("shingles"))
    blocks = F.greatest(F.ceil(F.col("docs") / BLOCK_DOCS), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    nodes = _in_blocks(nodes, "cluster", sizes.select("cluster", blocks.alias("blocks"))).drop("n_shingles")
    placed = _placed(docs).select("place", "text").join(nodes, "place").drop("place")
    placed = placed.repartition("cluster", "block_a", "block_b").sortWithinPartitions("cluster", "block_a", "block_b")
    return placed.mapInArrow(_verify(like), "a long, b long")


def _resolved(docs: DataFrame, like: Likeness) -> DataFrame:
    """(doc_id, text_key, n_shingles, first_id, first_key) of every row: the first document of its component by doc_id, nulls last."""
    sketched = common.stored(sketches(docs, like.words), "sketches")
    full = sketched.where("n_shingles > 0")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key", "rid")).alias("least")
    classes = common.stored(full.groupBy("sign_a", "sign_b").agg(least).select("sign_a", "sign_b", "least", F.col("least.rid").alias("rid")), "classes")
    shown = classes.select("rid").join(full.select("rid", "n_shingles", "registers"), "rid")
    near = components(candidate_edges(common.stored(shown, "class-sketches"), like))
    joined = components(common.stored(verified_edges(docs, full, near, like), "links"))
    # From here on rows are small: a class each, then a document each.
    member = classes.join(joined, F.col("rid") == F.col("node"), "left").select("sign_a", "sign_b", "least", F.coalesce("root", "rid").alias("root"))
    first = member.groupBy("root").agg(F.min("least").alias("first"))
    of_class = member.join(first, "root").select("sign_a", "sign_b", F.col("first.doc_id").alias("first_id"), F.col("first.text_key").alias("first_key"))
    rows = ["doc_id", "text_key", "n_shingles", "first_id", "first_key"]
    linked = full.join(of_class, ["sign_a", "sign_b"]).select(*rows)
    alone = sketched.where("n_shingles = 0").withColumns({"first_id": F.col("doc_id"), "first_key": F.col("text_key")})
    return linked.unionByName(alone.select(*rows))


def near_duplicates(docs: DataFrame, like: Likeness = Likeness()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row.

    Documents whose sets have a Jaccard similarity of at least part / whole are
    linked; component_id is the smallest doc_id that links reach, the document
    itself included. A document without words is alone. Repeated rows share a
    component, and the first is kept as often as it stands there; a null doc_id
    comes after all others. An empty table gives no rows.
    """
    kept = F.col("doc_id").eqNullSafe(F.col("first_id")).alias("kept")
    return _resolved(docs, like).select("doc_id", "n_shingles", F.col("first_id").alias("component_id"), kept)


def kept_documents(docs: DataFrame, like: Likeness = Likeness()) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: the first document of each component, once; all columns stay."""
    own = _resolved(docs, like).where(F.col("doc_id").eqNullSafe(F.col("first_id")) & F.col("text_key").eqNullSafe(F.col("first_key")))
    own = own.select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key")).distinct()
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & F.xxhash64(F.col("text").cast("string")).eqNullSafe(F.col("__key"))
    return docs.join(own, same).dropDuplicates(["__id", "__key"]).select(*docs.columns)


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(common.table(spark, sf_dir, "documents"), Likeness(words=3, part=85))
