"""The driver contract: names, and every query against its SQL over the smallest tables."""

import re

import pytest

import __spark_entry__ as contract
from checks.compare import compare, connect
from checks.queries import ORACLES, QUERIES


def test_flagship(spark):
    df = contract.entry(spark)
    assert df.count() == 146
    assert df.columns[:2] == ["customer_id", "avg_transaction_amount"]


def test_registry():
    assert set(ORACLES) <= set(QUERIES) <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql()) <= set(contract.queries())
    assert set(QUERIES) == set(ORACLES)  # the learners too
    for sql in ORACLES.values():  # row caps only inside the ranking of a mode
        assert len(re.findall(r"\bLIMIT\b", sql)) == len(re.findall(r"DESC, \w+ LIMIT 1\)", sql))


@pytest.fixture(scope="module")
def db(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, db, sf, name):
    assert compare(spark, db, name, sf) is None
