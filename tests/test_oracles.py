import pytest

import __spark_entry__ as driver
from compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"
# Queries of optional parts have tests of their own.
QUERIES, ORACLES = driver.QUERIES, driver.ORACLES


@pytest.fixture(scope="module")
def duck():
    connection = connect(SF_DIR)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, SF_DIR), duck, ORACLES[name]) == []


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert driver.entry(spark).count() == 5
