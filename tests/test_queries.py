"""Every registered query runs; those with SQL give the same rows as DuckDB."""

import pytest
from compare import compare, oracle_connection

import __spark_entry__ as entry_module
from flowmosaic.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return oracle_connection(SF)


def test_entry(spark):
    rows = entry_module.entry(spark).collect()
    assert len(rows) == 7 and sum(r["label"] for r in rows) == 2


def test_every_oracle_has_a_query():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    assert compare(QUERIES[name](spark, SF), duck, ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    frame = QUERIES[name](spark, SF)
    rows = frame.collect()
    assert rows and all(v is not None for row in rows for v in row)
