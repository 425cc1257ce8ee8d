"""Every query against its SQL on the smallest sample."""

import os

import pytest
from conftest import SAMPLE

import __spark_entry__ as contract
from bazaarlake.plans.queries import QUERIES
from oracle.check import database, difference
from oracle.sql import ORACLES

pytestmark = pytest.mark.skipif(
    not os.path.isdir(SAMPLE), reason="sample tables not present"
)


@pytest.fixture(scope="module")
def db():
    return database(SAMPLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, db, name):
    assert difference(QUERIES[name](spark, SAMPLE), ORACLES[name], db) == ""


def test_every_oracle_has_a_query():
    assert set(ORACLES) == set(QUERIES)


def test_the_contract_has_them_all():
    assert QUERIES.items() <= contract.queries().items()
    assert ORACLES.items() <= contract.oracle_sql().items()


def test_entry(spark):
    assert contract.entry(spark).count() > 0
