"""Every query against its SQL, and the driver contract."""

import pytest
from check_queries import compare, duck

import __spark_entry__ as contract
from quillmark.plans import catalogue

NAMES = list(catalogue.all_queries())


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_sql():
    assert set(NAMES) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, sf_dir, name):
    assert compare(contract.queries()[name](spark, sf_dir), con, contract.oracle_sql()[name]) is None


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert {r.difficulty for r in rows} == {"Easy", "Medium", "Hard", "all"}
