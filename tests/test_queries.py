import __spark_entry__ as driver
import pytest
from conftest import SF
from oracle import compare, connect

QUERIES, ORACLES = driver.queries(), driver.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, con, name):
    message, n = compare(spark, con, QUERIES[name], ORACLES[name], SF)
    assert message is None, message
    assert n > 0


def test_only_training_data_queries_lack_sql():
    assert all(name == "pipeline" or name.startswith("op") for name in QUERIES.keys() - ORACLES.keys())


def test_entry(spark):
    found = driver.entry(spark).collect()
    assert [r["rank"] for r in found] == list(range(1, 11))
    assert found[0]["score"] == 1.0
