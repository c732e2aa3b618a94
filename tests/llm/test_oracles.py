import pytest

from sensorlake.llm.queries import ORACLES, QUERIES
from tests.oracle import difference


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_oracle(spark, sf_dir, name):
    assert difference(spark, sf_dir, name) is None
