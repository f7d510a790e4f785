"""Every registered query against its SQL."""

import pytest
from compare import difference, duck

import __spark_entry__ as contract
from workload.queries import QUERIES


@pytest.fixture(scope="module")
def con(folder):
    return duck(folder)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, folder, con, name):
    assert difference(contract.queries()[name](spark, folder), con, contract.oracle_sql()[name]) is None


def test_entry_has_rows(spark):
    df = contract.entry(spark)
    assert df.columns == ["customerkey", "cohor_y_q"]
    labels = [r.cohor_y_q for r in df.collect()]
    assert labels and labels == sorted(labels)
