"""Every registered query against its DuckDB oracle SQL on the sf0.001
tables (the driver repeats this at sf0.01).  Doubles must be bit-identical,
not just equal at 6 decimals."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from tillroll.plans import registry
import tools.oracle_check as oracle_check
from tools.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="driver test data not present")


@pytest.fixture(scope="module")
def con():
    oracle_check.STRICT = True
    yield duck(SF)
    oracle_check.STRICT = False


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, entry.queries()[name], entry.oracle_sql().get(name), SF)
    assert ok, msg


def test_every_query_has_oracle():
    assert set(registry.queries()) == set(registry.oracle_sql())
    assert set(registry.queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_returns_rows(spark):
    df = entry.entry(spark)
    assert df.columns == ["department_name", "lines"] and df.count() > 0
