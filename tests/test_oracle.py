"""Every registered query against its DuckDB oracle at sf0.01 (the driver's correctness gate)."""

import pytest

import __spark_entry__ as entry
from __spark_entry__ import ORACLE as LIBRARY_ORACLE
from __spark_entry__ import QUERIES as LIBRARY
from oracle_compare import compare, duck_connection
from table_dirs import SF_ORACLE, SF_SMALL

QUERIES = entry.queries()
ORACLE = entry.oracle_sql()


def test_every_query_has_an_oracle():
    assert set(ORACLE) <= set(QUERIES)
    assert set(LIBRARY) == set(LIBRARY_ORACLE) and set(LIBRARY) <= set(QUERIES)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert "vehicle_id" in df.columns and "distance_km" in df.columns


@pytest.fixture(scope="module")
def duck():
    return duck_connection(SF_ORACLE)


@pytest.mark.parametrize("name", sorted(LIBRARY_ORACLE))
def test_query_matches_oracle(spark, duck, name):
    r = compare(spark, SF_ORACLE, name, QUERIES[name], ORACLE[name], duck)
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r


@pytest.mark.parametrize("name", ["D2_daily", "E2_latest_status", "I5_scd2_history"])
def test_small_scale_also_matches(spark, name):
    r = compare(spark, SF_SMALL, name, QUERIES[name], ORACLE[name])
    assert r["values_match"], r
