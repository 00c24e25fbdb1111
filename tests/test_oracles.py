"""Every query that has an equivalent in SQL gives the same rows in a second engine."""

import oracle
import pytest

from changeflow.plans.oracles import ORACLES
from changeflow.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", list(ORACLES))
def test_same_rows(spark, con, sf_dir, name):
    assert oracle.difference(spark, con, QUERIES[name], ORACLES[name], sf_dir) is None


def test_every_query_has_sql():
    assert sorted(QUERIES) == sorted(ORACLES)
