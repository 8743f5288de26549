"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from quotewell.plans.oracle import ORACLE_SQL
from quotewell.plans.queries import QUERIES
from tests.check import differences, oracle

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE_SQL) <= set(entry.oracle_sql())


def test_entry_has_rows_and_schema(spark):
    result = entry.entry(spark)
    assert result.columns[:2] == ["symbol", "sector"] and result.columns[-1] == "signal"
    assert result.count() == 10


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert differences(spark, con, name, QUERIES[name], ORACLE_SQL[name], SF_DIR) == ""
