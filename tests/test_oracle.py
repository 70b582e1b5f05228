"""Every registered query against its DuckDB oracle on the smallest test tables."""

import os

import pytest

import __spark_entry__ as E
from strata.plans.catalog import QUERIES
from tools.compare_oracle import canon, duck

SF = "/root/testdata/sf0.001"
NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF):
        pytest.skip("test tables not present")
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    res = con.execute(E.oracle_sql()[name])
    spark_side = canon(df.columns, [tuple(r) for r in df.collect()])
    duck_side = canon([d[0] for d in res.description], res.fetchall())
    assert spark_side == duck_side


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[:3] == ["event_id", "ts", "user_id"]
    assert df.count() >= 0


@pytest.mark.parametrize("name", ["pit_events", "ingestion_as_of", "freshness", "health_report", "latest_health", "asof_bulk"])
def test_results_do_not_depend_on_the_session_zone(spark, con, name):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = E.queries()[name](spark, SF)
        spark_side = canon(df.columns, [tuple(r) for r in df.collect()])
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    res = con.execute(E.oracle_sql()[name])
    assert spark_side == canon([d[0] for d in res.description], res.fetchall())
