"""Exact order statistics without sorting the data or gathering it.

Spark's exact percentile keeps every distinct value in one buffer, which
continuous sensor readings would fill. Here each pass counts values in
equal-width buckets, partial counts combine before the shuffle, and only the
bucket that holds the wanted rank is looked at again. What reaches the driver
is at most ``BUCKETS`` counts per search and pass, whatever the data holds.
Every pass splits the remaining interval at its own minimum and maximum, and
infinities are counted apart from finite values, so the search always ends; readings on a sensor's grid end after the first pass.
"""

from dataclasses import dataclass, replace
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096


@dataclass(frozen=True)
class Selected:
    """A value; how many of all ``total`` values are smaller, how many equal."""

    value: float
    below: int
    equal: int
    total: int


@dataclass(frozen=True)
class _Search:
    name: str
    column: Column
    kind: str
    low: float
    high: float
    rank: int | None = None
    below: int = 0
    total: int = 0
    first: bool = True


def _bucket(search: _Search, value: Column) -> Column:
    """Bucket of a value; infinities have one each outside the finite ones.

    Halves keep the width of any two doubles finite.
    """
    if search.kind == "double":
        part = (value / 2 - F.lit(search.low / 2)) / F.lit(search.high / 2 - search.low / 2)
    else:
        part = (value - F.lit(search.low).cast(search.kind)).cast("double") / F.lit(float(search.high - search.low))
    inside = F.floor(F.least(F.greatest(part * BUCKETS, F.lit(0.0)), F.lit(BUCKETS - 1.0))).cast("int")
    if search.kind != "double":
        return inside
    return F.when(value == float("inf"), BUCKETS).when(value == float("-inf"), -1).otherwise(inside)


def _wanted(search: _Search) -> Column:
    """The values a pass looks at. The first takes all: bounds only guide it,
    and what lies outside is counted in the outermost buckets."""
    if search.first:
        return search.column.isNotNull() & ~F.isnan(search.column) if search.kind == "double" else search.column.isNotNull()
    return search.column.between(F.lit(search.low).cast(search.kind), F.lit(search.high).cast(search.kind))


def _count_pass(df: DataFrame, searches: list[_Search], scanned: bool) -> dict[int, list]:
    """Count, minimum and maximum per bucket for all searches in one job."""
    found = {}
    for kind in sorted({s.kind for s in searches}):
        mine = [(i, s) for i, s in enumerate(searches) if s.kind == kind]
        # Of columns of a table, rows outside all intervals go first: the scan skips
        # them. A computed column, such as a digest, is not filtered by: a filter
        # would compute it for every mention, the projection does so once a row.
        inside = df.filter(reduce(or_, [_wanted(s) for _, s in mine])) if scanned else df
        values = inside.select(*[F.when(_wanted(s), s.column).alias(f"v{i}") for i, s in mine])
        entries = [F.struct(F.lit(i).alias("search"), _bucket(s, F.col(f"v{i}")).alias("bucket"),
                            F.col(f"v{i}").alias("value")) for i, s in mine]
        counted = (
            values.select(F.inline(F.array(*entries)))
            .filter(F.col("value").isNotNull())
            .groupBy("search", "bucket")
            .agg(F.count(F.lit(1)).alias("n"), F.min("value").alias("low"),
                 F.max("value").alias("high"))
        )
        for row in counted.collect():
            found.setdefault(row["search"], []).append(row)
    return {i: sorted(rows, key=lambda r: r["bucket"]) for i, rows in found.items()}


def _narrow(search: _Search, rows) -> Selected | _Search:
    seen = search.below
    for row in rows:
        if search.rank < seen + row["n"]:
            if row["low"] == row["high"]:
                return Selected(row["low"], seen, row["n"], search.total)
            return replace(search, low=row["low"], high=row["high"], below=seen, first=False)
        seen += row["n"]
    raise ValueError(f"rank {search.rank} is outside the {seen} values of {search.name}")


def select_ranks(df: DataFrame, columns: dict[str, tuple], ranks_of, scanned: bool = True) -> dict[str, list[Selected]]:
    """Values at given ranks of several columns.

    ``columns`` maps a name to ``(column, type, low, high)``; bounds that
    enclose most values save passes. ``ranks_of(n)`` gives the wanted zero-based
    ranks among ``n`` values. NULL and NaN are left out. A column without values
    maps to ``[]``. Say ``scanned=False`` where columns are dear to compute.
    """
    start = [_Search(n, c, kind, low, high) for n, (c, kind, low, high) in columns.items()]
    first = _count_pass(df, start, scanned)
    done: dict[str, dict[int, Selected]] = {s.name: {} for s in start}
    order: dict[str, list[int]] = {}
    pending: list[_Search] = []
    for i, search in enumerate(start):
        rows = first.get(i, [])
        total = sum(r["n"] for r in rows)
        order[search.name] = list(ranks_of(total)) if total else []
        for rank in dict.fromkeys(order[search.name]):
            outcome = _narrow(replace(search, rank=rank, total=total), rows)
            if isinstance(outcome, Selected):
                done[search.name][rank] = outcome
            else:
                pending.append(outcome)
    while pending:
        # Ranks that fell into the same bucket share one search.
        spans = {}
        for s in pending:
            spans.setdefault((s.name, s.low, s.high), []).append(s)
        passed = _count_pass(df, [group[0] for group in spans.values()], scanned)
        pending = []
        for i, group in enumerate(spans.values()):
            for search in group:
                outcome = _narrow(search, passed[i])
                if isinstance(outcome, Selected):
                    done[search.name][search.rank] = outcome
                else:
                    pending.append(outcome)
    return {name: [done[name][r] for r in ranks] for name, ranks in order.items()}


def exact_medians(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> dict[str, float | None]:
    """Median of each column with usual bounds; the middle pair is averaged."""
    picked = select_ranks(
        df,
        {c: (F.col(c), "double", low, high) for c, (low, high) in bounds.items()},
        lambda n: [(n - 1) // 2, n // 2],
    )
    return {c: (v[0].value + (v[1].value - v[0].value) * 0.5) if v else None
            for c, v in picked.items()}
