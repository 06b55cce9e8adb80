import pytest

import __spark_entry__ as contract
from compare import connect, mismatch

QUERIES = contract.queries()
ORACLES = contract.oracle_sql()
# The training-data operators have brute-force tests of their own.
OWN = {q for q in QUERIES if q == "pipeline" or q.startswith("op") and q[2].isdigit()}


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) - set(ORACLES) <= OWN
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, sf_dir, name):
    assert mismatch(spark, duck, sf_dir, QUERIES[name], ORACLES[name]) is None


def test_entry(spark):
    assert contract.entry(spark).count() == 30
