import pytest

from amalgam.plans.catalog import ORACLES, QUERIES
from tests.oracle import compare

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_oracle(spark, name):
    compare(spark, SF, QUERIES[name], ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_oracle_repeats(spark, name):
    first, again = (sorted(map(str, QUERIES[name](spark, SF).collect())) for _ in range(2))
    assert first and first == again
