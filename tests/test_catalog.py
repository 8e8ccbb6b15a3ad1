"""Registered queries against their SQL on the smallest tables."""

import os
from functools import cache

import duckdb
import pytest

import __spark_entry__ as entry
from seriesmill.catalog import queries as catalog

SF = "/root/testdata/sf0.001"

SQL = entry.oracle_sql()


@pytest.fixture(scope="module", autouse=True)
def shared_inputs():
    """Forecasts and backtests that many queries present are computed once, not once a query."""
    names = ("brand_backtest", "brand_forecasts", "brand_view", "customer_view")
    kept = {n: getattr(catalog, n) for n in names}
    for n in names:
        setattr(catalog, n, cache(kept[n]))
    yield
    for n in names:
        setattr(catalog, n, kept[n])


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{SF}/{name}'")
    return con


def test_every_sql_has_a_query():
    assert set(SQL) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="sample tables not here")
@pytest.mark.parametrize("name", [n for n in entry.queries() if n in SQL])
def test_query_matches_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
    done = duck.execute(SQL[name])
    names = [d[0] for d in done.description]
    assert sorted(names) == columns
    want = sorted((tuple(r[names.index(c)] for c in columns) for r in done.fetchall()), key=repr)
    assert got == want
