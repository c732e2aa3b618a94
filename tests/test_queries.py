import pytest

import __spark_entry__ as contract
from sensorlake.registry.oracles import ORACLES
from sensorlake.registry.queries import QUERIES
from tests.oracle import difference


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_oracle(spark, sf_dir, name):
    assert difference(spark, sf_dir, name) is None


def test_golden_counts(spark, sf_dir):
    """Known counts over the smallest tables."""
    readings = contract.queries()["silver"](spark, sf_dir)
    flags = {r["quality_flag"]: r["count"] for r in readings.groupBy("quality_flag").count().collect()}
    assert flags == {
        "VALID": 822,
        "OUT_OF_RANGE_TEMP": 97,
        "ANOMALY_DETECTED": 43,
        "SENSOR_NULL_TEMP": 20,
        "SENSOR_NULL_ENERGY": 18,
    }
    assert contract.entry(spark).count() == 178
    assert contract.queries()["gold_equipment_health"](spark, sf_dir).count() == 15
    assert contract.queries()["gold_anomaly_alerts"](spark, sf_dir).count() == 178
