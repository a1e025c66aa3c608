import pytest

from gridspark.llm import oracles, queries
from tests import oracle


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_matches_oracle(spark, sf_dir, con, name):
    difference = oracle.compare(queries.QUERIES[name](spark, sf_dir), con, oracles.ORACLES[name])
    assert difference is None, difference


def test_oracles_belong_to_queries():
    assert set(oracles.ORACLES) <= set(queries.QUERIES)
