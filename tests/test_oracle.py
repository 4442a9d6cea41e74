"""Every registered query against its SQL oracle on the smallest tables."""

import pytest

import __spark_entry__ as entry
from queries.catalog import QUERIES
from queries.oracle import ORACLE
from tests.compare import differences, oracle_connection

SF = "/root/testdata/sf0.001"
# Too few rows at this scale for any to qualify.
MAY_BE_EMPTY = {"ingest", "ingest_clustered", "region_then_ship_scan", "vessels_not_through_zone"}


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.items() <= entry.queries().items() and ORACLE.items() <= entry.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    problem = differences(QUERIES[name](spark, SF), con, ORACLE[name])
    assert problem == "" or (problem == "empty" and name in MAY_BE_EMPTY)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "Port_Country_Origin" and df.count() > 0
