import pytest

from amalgam.llm.queries import ORACLES, QUERIES
from tests.oracle import compare


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_oracle(spark, name):
    assert compare(spark, "/root/testdata/sf0.01", QUERIES[name], ORACLES[name])
