"""Every plan with an SQL twin: Spark result == DuckDB result on sf0.001
(same column names, row count and order-insensitive value digest)."""

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SMALL
from kestrel.sources.fixtures import TABLES
from tools.oracle_check import _digest

SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    yield c
    c.close()


def test_every_oracle_has_a_plan():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("key", sorted(SQL))
def test_plan_matches_sql(spark, con, key):
    df = QUERIES[key](spark, SMALL)
    got = [tuple(r) for r in df.collect()]
    res = con.execute(SQL[key])
    cols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(want)
    assert _digest(df.columns, got)[0] == _digest(cols, want)[0]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["country", "host", "requests", "share_pct", "rank"]
    got = df.collect()
    assert {r.country for r in got} == {"JP", "UK", "US"}
    for country in ("JP", "UK", "US"):
        mine = sorted((r.rank, r.requests, r.share_pct, r.host) for r in got if r.country == country)
        assert [r[0] for r in mine] == [*range(1, len(mine)), 10] and mine[-1][3] == "rest"
        assert abs(sum(r[2] for r in mine) - 100) < 1e-4
        assert all(a[1] >= b[1] for a, b in zip(mine[:-1], mine[1:-1]))
