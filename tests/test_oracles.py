"""Every registered query against its SQL on the small tables."""

import pytest

from liftplan.suite.queries import ORACLES, QUERIES
from tests.compare import compare_key, duck

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_equals_sql(spark, con, key):
    problem, _ = compare_key(spark, con, FOLDER, key)
    assert problem is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
