"""Every named query gives the rows of its SQL on the smallest tables."""

import pytest
from compare import database, differences

import __spark_entry__ as driver

SF_DIR = "/root/testdata/sf0.001"
QUERIES, SQL = driver.queries(), driver.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return database(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    ours = QUERIES[name](spark, SF_DIR).toArrow()
    if name in SQL:
        assert differences(ours, con.sql(SQL[name]).to_arrow_table()) == []
    else:
        assert ours.num_rows > 0


def test_entry(spark):
    assert driver.entry(spark).count() > 0
