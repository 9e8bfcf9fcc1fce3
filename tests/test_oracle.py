"""Every query against its SQL twin on the driver's tables."""

import os

import pytest
from comparison import connect, mismatch, plan

import __spark_entry__ as contract
from pacewell.plans import queries as plans
from pacewell.plans.oracles import ORACLES as ORACLE_SQL

SF_DIR = os.environ.get("PACEWELL_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = dict(plans.QUERIES), dict(ORACLE_SQL)


@pytest.fixture(scope="module")
def con():
    with connect(SF_DIR) as connection:
        yield connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    text = plan(df)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow"):
        assert node not in text
    assert mismatch(df, con, ORACLES[name]) is None


def test_every_query_is_registered_and_has_sql():
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(contract.queries())


def test_model_query_invariants(spark):
    groups = {r["split"]: r for r in QUERIES["m03_forest_fit"](spark, SF_DIR).collect()}
    assert groups["test"]["is_good"] == groups["train"]["is_good"] == 1


def test_entry_has_rows(spark):
    assert contract.entry(spark).take(1)


def counted(df, *keys):
    return {tuple(r)[:-1] if len(keys) > 1 else r[0]: r["count"] for r in df.groupBy(*keys).count().collect()}


def test_known_counts_of_the_tables(spark):
    """Counts found independently when the mapping of the tables was made."""
    sf_dir = "/root/testdata/sf0.01"
    assert counted(QUERIES["o16_hold_state"](spark, sf_dir), "state") == {
        "firing": 33, "pending": 227, "inactive": 460}
    sizes = {r["split"]: r["n_rows"] for r in QUERIES["d05_sample_counts"](spark, sf_dir).collect()}
    assert sizes == {"train": 23698, "test": 5947}
    up = QUERIES["o15_service_down"](spark, sf_dir).groupBy("job").sum("value").collect()
    assert {r[0]: r[1] for r in up} == {"api": 720, "data-ingestion": 686, "ml-trainer": 545}
    assert counted(QUERIES["d04_exact_split"](spark, sf_dir), "split") == {"test": 12000, "train": 48000}
