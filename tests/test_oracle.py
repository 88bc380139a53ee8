"""Every registered query against DuckDB, row by row."""

import pytest

import __spark_entry__ as contract
from lendmill.catalogue import ORACLE, QUERIES
from tests import oracle

SF_DIRS = ["/root/testdata/sf0.001", "/root/testdata/sf0.01"]


@pytest.fixture(scope="module", params=SF_DIRS, ids=["sf0.001", "sf0.01"])
def scale(request):
    con = oracle.connect(request.param)
    yield request.param, con
    con.close()


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_same_rows(spark, scale, name):
    sf_dir, con = scale
    names, rows = oracle.spark_rows(contract.queries()[name](spark, sf_dir))
    wanted_names, wanted = oracle.duckdb_rows(con, contract.oracle_sql()[name])
    assert names == wanted_names
    assert len(rows) == len(wanted) > 0
    assert rows == wanted


def test_every_query_of_the_catalogue_has_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= contract.queries().keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


def test_entry(spark):
    assert contract.entry(spark).count() > 0
