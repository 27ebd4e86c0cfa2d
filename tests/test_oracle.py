"""Every registered query equals its DuckDB oracle (rows, columns, values)."""

import pytest

from conftest import SF001
from flowlake.plans.catalog import ORACLE, QUERIES

import importlib.util
import os

_spec = importlib.util.spec_from_file_location(
    "oracle_check", os.path.join(os.path.dirname(__file__), "..", "scripts", "oracle_check.py"))
oracle_check = importlib.util.module_from_spec(_spec)
_spec.loader.exec_module(oracle_check)


def test_every_query_has_oracle_or_is_listed():
    assert set(ORACLE) <= set(QUERIES)
    assert len(QUERIES) >= 40


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle_sf0001(spark, key):
    res = oracle_check.compare(spark, SF001, [key], verbose=False)[key]
    if key in ORACLE:
        assert res["spark_rows"] == res["oracle_rows"]
        assert res["cols"], key
        assert res["values"], key


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert set(QUERIES) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_query_matches_oracle_through_pandas_sf0001(spark, key):
    """The stricter view: Spark toPandas vs DuckDB .df(), dtypes and text values."""
    assert oracle_check.compare_pandas(spark, SF001, [key], verbose=False) == {}
