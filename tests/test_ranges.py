"""Range vectors on a grid against plain Python over every range."""

import random
from datetime import datetime, timedelta

import pytest

from pacewell.operators import ranges

START = datetime(2031, 5, 4)
SCHEMA = "ts timestamp, job string, n long, up long"


@pytest.fixture(scope="module")
def rows():
    """Series of different density with restarts, gaps, ties, samples on steps and missing values."""
    rng, out = random.Random(2), []
    for job, gap in (("api", 20), (None, 200), ("rare", 4000)):
        at, v = START, 3
        for n in range(200):
            at += timedelta(seconds=rng.choice([0, 1, 15, gap, rng.uniform(0, 2 * gap)]) + (5000 if n == 90 else 0))
            v = rng.randint(0, 2) if rng.random() < 0.06 else v + rng.randint(0, 5)
            out.append((at, job, n, None if rng.random() < 0.03 else v))
    return [*out, (None, "api", 1, 1)]


def in_ranges(rows, step, width):
    for job in {r[1] for r in rows}:
        own = sorted((r[0], r[2], r[3]) for r in rows if r[1] == job and r[0] is not None and r[3] is not None)
        first = int((own[0][0] - START).total_seconds() // step)
        last = int(((own[-1][0] - START).total_seconds() + width) // step) + 2
        for i in range(first, last):
            end = START + timedelta(seconds=i * step)
            inside = [s for s in own if end - timedelta(seconds=width) < s[0] <= end]
            if inside:
                yield job or "", end, inside


def plain_increase(rows, step, width):
    out = {}
    for job, end, inside in in_ranges(rows, step, width):
        span = (inside[-1][0] - inside[0][0]).total_seconds()
        if len(inside) < 2 or span == 0:
            continue
        raw = sum(b[2] if b[2] < a[2] else b[2] - a[2] for a, b in zip(inside, inside[1:]))
        mean = span / (len(inside) - 1)
        head = width - (end - inside[0][0]).total_seconds()
        tail = (end - inside[-1][0]).total_seconds()
        head, tail = (mean / 2 if gap >= mean * 1.1 else gap for gap in (head, tail))
        if raw > 0:
            head = min(head, span * inside[0][2] / raw)
        out[job, end] = (len(inside), raw * (span + head + tail) / span)
    return out


@pytest.mark.parametrize("step, width, slices", [(15, 300, None), (15, 300, 300), (60, 60, 120), (300, 3600, None), (100, 250, 300)])
def test_increase_equals_plain_ranges(spark, rows, step, width, slices):
    df = spark.createDataFrame(rows, SCHEMA)
    found = {(r["job"], r["ts"]): (r["n_samples"], r["increase"], r["rate"])
             for r in ranges.range_increase(df, ["job"], "ts", "up", step, width, ["n"], slices).collect()}
    wanted = plain_increase(rows, step, width)
    assert found.keys() == wanted.keys() and len(wanted) > 50
    for at, (n, increase) in wanted.items():
        assert found[at] == (n, pytest.approx(increase), pytest.approx(increase / width))


def test_last_sample_within_the_look_back(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    found = {(r["job"], r["ts"]): r["value"] for r in ranges.last_within(df, ["job"], "ts", "up", 15, 300, ["n"]).collect()}
    assert found == {(job, end): inside[-1][2] for job, end, inside in in_ranges(rows, 15, 300)}


def test_a_silent_service_is_not_up(spark):
    times = [(START + timedelta(seconds=15 * i), job, i, 1) for job, until in (("a", 40), ("b", 10)) for i in range(until)]
    at = {r["ts"]: (r["services_up"], r["n_known"]) for r in ranges.services_up_at(spark.createDataFrame(times, SCHEMA)).collect()}
    assert at[START] == (2, 2) and at[START + timedelta(seconds=9 * 15 + 285)] == (2, 2)
    assert at[START + timedelta(seconds=9 * 15 + 300)] == (1, 1)
    assert max(at) == START + timedelta(seconds=39 * 15 + 285)


def test_slices_must_fit(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    with pytest.raises(ValueError):
        ranges.last_within(df, ["job"], "ts", "up", 15, 300, (), 150)
    with pytest.raises(ValueError):
        ranges.last_within(df, ["job"], "ts", "up", 15, 300, (), 310)
    assert ranges.range_increase(df.limit(0), ["job"], "ts", "up", 15, 300).count() == 0


def test_samples_become_panes_before_they_are_moved_on(spark, rows):
    """A slice of raw samples grows with their density, a slice of panes does not."""
    df = spark.createDataFrame(rows, SCHEMA)
    last = ranges.last_within(df, ["job"], "ts", "up", 15, 300, ["n"])._jdf.queryExecution().executedPlan().toString()
    grown = ranges.range_increase(df, ["job"], "ts", "up", 15, 300, ["n"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in last and "partial_max_by" in grown
    assert not [line for line in (last + grown).splitlines() if "Window" in line and "_us" in line and "_pane" not in line]
