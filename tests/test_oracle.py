"""Every query with SQL gives the rows that DuckDB gives."""

import math

import duckdb
import pytest

from ledgerloom.plans import registry
from ledgerloom.plans.views import TABLES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return ""
    if isinstance(v, bool):
        return str(v)
    return f"{float(v):.5f}" if isinstance(v, (int, float)) or type(v).__name__ == "Decimal" else str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_same_rows(spark, con, name):
    want = con.execute(registry.oracle_sql()[name])
    columns, rows = [d[0] for d in want.description], want.fetchall()
    got = registry.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    assert rows_of(got.columns, [tuple(r) for r in got.collect()]) == rows_of(columns, rows)


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_runs(spark, name):
    assert registry.queries()[name](spark, SF).count() > 0
