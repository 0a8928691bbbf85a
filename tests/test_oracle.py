"""Every catalog query equals its DuckDB oracle at sf0.01 (same check as the
driver: row count, column names, order-insensitive values)."""

import pytest

import __spark_entry__ as entry
from conftest import SF01
from cabgrid.plans import ALL_ORACLE_SQL, ALL_QUERIES
from oracle_compare import compare

NAMES = sorted(ALL_QUERIES)


def test_every_query_has_oracle():
    assert set(ALL_ORACLE_SQL) == set(ALL_QUERIES)
    assert set(ALL_QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    r = compare(spark, name, entry.queries()[name], entry.oracle_sql()[name], SF01)
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0
    assert df.columns == ["cell", "window_end", "area_profit", "num_empty_taxis", "profitability"]
