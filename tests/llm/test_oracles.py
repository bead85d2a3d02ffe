"""The SQL of operators that SQL can express, on the smallest tables."""

from pathlib import Path

import pytest

from checks.compare import duckdb_views, normalised
from skyrisk.llm import registry

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="driver tables absent")


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_its_sql(spark, name):
    pytest.importorskip("duckdb")
    df = registry.QUERIES[name](spark, FOLDER)
    answer = duckdb_views(FOLDER).execute(registry.ORACLES[name])
    columns = [c[0] for c in answer.description]
    assert sorted(columns) == sorted(df.columns)
    assert normalised(df.columns, [tuple(r) for r in df.collect()]) == normalised(columns, answer.fetchall())
