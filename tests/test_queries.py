"""Every registered query against its SQL at the smallest scale."""

import pytest

import __spark_entry__ as entry
from gridloom import queries as registry
from tests.check_oracles import compare, database
from tests.conftest import SF


@pytest.fixture(scope="module")
def con():
    return database(SF)


@pytest.mark.parametrize("name", list(registry.queries()))
def test_query_equals_sql(spark, con, name):
    assert name in registry.oracle_sql()
    rows, problems = compare(spark, con, SF, name)
    assert not problems
    assert rows > 0


def test_entry_runs(spark):
    assert entry.entry(spark).columns[:4] == ["time_c", "step_c", "latitude_c", "longitude_c"]
