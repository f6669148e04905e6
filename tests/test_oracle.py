"""Every registered query against its DuckDB oracle on the smallest test data."""

import pytest

from vitrina.plans.catalog import catalogue
from compare import compare, duckdb_connection

from conftest import SMALL_SF

NAMES = list(catalogue())


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SMALL_SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    result = compare(spark, con, catalogue()[name], SMALL_SF)
    assert result["columns_match"], result
    assert result["spark_rows"] == result["oracle_rows"], result
    assert result["match"], result


def test_entry_points(spark):
    import importlib.util
    import os

    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")
    spec = importlib.util.spec_from_file_location("spark_entry", path)
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    df = mod.entry(spark)
    assert len(df.columns) == 78
    assert df.count() > 0
    assert set(catalogue()) <= set(mod.queries()) and set(catalogue()) <= set(mod.oracle_sql())
    assert set(mod.oracle_sql()) <= set(mod.queries())
