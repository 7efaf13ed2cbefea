import os

import pytest

import __spark_entry__ as driver
from checks import oracle, registry
from checks.compare import connection, differs

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    return connection(SF)


def test_flagship(spark):
    df = driver.entry(spark)
    assert df.columns == ["source_instance", "snapshot_time_utc", "wait_type", "wait_ms_delta", "wait_category"]
    assert df.count() > 0


def test_every_statement_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert set(oracle.statements()) == set(registry.callables())


@pytest.mark.parametrize("name", sorted(driver.queries()))
def test_query_agrees_with_sql(spark, duck, name):
    got = driver.queries()[name](spark, SF).toPandas()
    statement = driver.oracle_sql().get(name)
    if statement is not None:
        assert differs(got, duck.execute(statement).df()) is None
