"""Every registered query that has a SQL oracle against it; those of the core all have one."""

import os

import pytest
from compare import connect, duck_result, spark_result

import __spark_entry__ as contract
from checks.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_of_the_core_has_an_oracle():
    assert set(QUERIES) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_oracle(spark, duck, name):
    columns, rows = spark_result(contract.queries()[name](spark, SF_DIR))
    expected_columns, expected = duck_result(duck, contract.oracle_sql()[name])
    assert columns == expected_columns
    assert len(rows) == len(expected)
    assert rows == expected


def test_entry_gives_rows(spark):
    assert contract.entry(spark).limit(1).count() == 1
