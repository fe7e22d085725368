import pytest

import __spark_entry__ as contract
from shiftpay.plans import registry
from compare import connect, differences

DATA = "/root/testdata/sf0.001"
ORACLE = registry.oracle_sql()


@pytest.fixture(scope="module")
def db():
    return connect(DATA)


def test_every_query_has_sql():
    assert set(ORACLE) == set(registry.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_equals_sql(spark, db, name):
    assert differences(registry.queries()[name](spark, DATA), db, ORACLE[name]) == []
