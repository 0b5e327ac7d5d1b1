import os

import duckdb
import pytest

import __spark_entry__ as registered
from check import duck, same
from tidemark.plans.queries import ORACLES, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason=f"no test tables at {SF}")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_its_sql(spark, con, name):
    df = registered.queries()[name](spark, SF)
    assert isinstance(con, duckdb.DuckDBPyConnection)
    assert same(df, con, registered.oracle_sql()[name]) == ""


def test_every_query_has_its_sql():
    assert set(ORACLES) == set(QUERIES)


def test_all_of_them_are_registered():
    assert QUERIES.items() <= registered.queries().items()
    assert ORACLES.items() <= registered.oracle_sql().items()


def test_entry(spark):
    assert registered.entry(spark).count() > 0
