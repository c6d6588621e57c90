"""Every query of the catalogue against its SQL on the smallest tables."""

import pytest

from check_queries import differences, oracle
from conftest import SMALL
from passages.plans.catalog import QUERIES
from passages.plans.oracles import ORACLES


@pytest.fixture(scope="module")
def con():
    return oracle(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SMALL), con, ORACLES[name]) == []
