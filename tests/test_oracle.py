"""Every query against its SQL twin."""

import pytest
from check_oracle import compare, connect
from conftest import SF_DIR

import __spark_entry__ as contract

QUERIES, ORACLE = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, duck, name):
    assert compare(QUERIES[name](spark, SF_DIR), duck, ORACLE[name]) is None


def test_names_agree():
    assert set(ORACLE) <= set(QUERIES)
    assert set(contract.QUERIES) == set(contract.ORACLE)


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() == 10
