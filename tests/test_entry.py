"""The driver's contract, and every query with SQL against DuckDB on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from checks.compare import differences, duckdb_views
from checks.registry import ORACLES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="driver tables absent")


@pytest.fixture(scope="module")
def con():
    pytest.importorskip("duckdb")
    return duckdb_views(FOLDER)


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


# These learn a model, for which the smallest tables hold no complete training row.
FITTED = {"forest_relations", "importance_relations", "comparison_relations", "scored_relations", "historical_relations"}


@pytest.mark.parametrize("name", sorted(set(ORACLES) - FITTED))
def test_query_equals_its_sql(spark, con, name):
    assert differences(spark, con, name, FOLDER) is None
