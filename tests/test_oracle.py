"""Every registered query equals its SQL oracle (DuckDB) on sf0.01, exactly."""

import pytest

import __spark_entry__ as entry
from roadpulse.plans import registry
from tests.oracle_check import compare, duck
from tests.conftest import SF0001, SF001

registry.load_all()
QUERIES = {name: fn for name, fn in entry.queries().items() if name in registry.QUERIES}
ORACLE = {name: sql for name, sql in entry.oracle_sql().items() if name in registry.QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    problems, rows = compare(spark, con, name, QUERIES[name], ORACLE[name], SF001)
    assert not problems, problems
    assert rows > 0


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns[:3] == ["report_date", "sensor_id", "peak_hour"]


@pytest.mark.parametrize("name", ["daily_report", "peak_hour_analysis", "hourly_resample", "tumbling_5min"])
def test_small_scale_matches_oracle(spark, name):
    problems, _ = compare(spark, duck(SF0001), name, QUERIES[name], ORACLE[name], SF0001)
    assert not problems, problems
