"""Every registered query against its SQL."""

import pytest
from compare import difference

from tablestream.plans import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, name):
    assert difference(spark, DATA, QUERIES[name], ORACLES[name]) is None


def test_entry_has_rows(spark):
    import __spark_entry__ as driver

    assert driver.entry(spark).limit(1).count() == 1
    assert set(driver.oracle_sql()) <= set(driver.queries())
