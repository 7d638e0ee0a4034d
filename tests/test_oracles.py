"""Every registered query against its SQL, over the smallest given tables."""

import pytest

import __spark_entry__ as driver
from tests.compare import compare, connect
from touchline.plans import oracles, registry

SF_DIR = "/root/testdata/sf0.001"
QUERIES = registry.queries()
ORACLES = oracles.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = connect(SF_DIR)
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(driver.queries()) and set(driver.oracle_sql()) <= set(driver.queries())


def test_entry_returns_rows(spark):
    rows = driver.entry(spark).collect()
    assert rows and rows[0].engagement >= rows[-1].engagement


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    compare(spark, duck, name, QUERIES[name], ORACLES[name], SF_DIR)
