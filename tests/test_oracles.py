import pytest

import __spark_entry__ as contract
from gridspark.plans import catalog, oracles
from tests import oracle


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_matches_oracle(spark, sf_dir, con, name):
    difference = oracle.compare(
        contract.queries()[name](spark, sf_dir), con, contract.oracle_sql()[name]
    )
    assert difference is None, difference


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(oracles.ORACLES)


def test_contract_has_all_queries():
    assert set(catalog.QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
