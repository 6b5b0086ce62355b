import pytest
from conftest import SMALL
from oracle import compare, connect

import __spark_entry__ as contract
from contrail.plans.oracles import ORACLES
from contrail.plans.queries import registry

CON = connect(SMALL)


def test_registry():
    assert set(registry()) == set(ORACLES)
    assert set(registry()) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["window_start", "window_end", "grid_cell", "aircraft_count", "avg_altitude_m", "avg_velocity_mps"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(registry()))
def test_query_matches_its_sql(spark, name):
    rows, problems = compare(registry()[name](spark, SMALL), CON, ORACLES[name])
    assert problems == [] and rows > 0
