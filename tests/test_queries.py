"""Every query that has a SQL twin gives what DuckDB gives on the smallest tables."""

import duckdb
import pytest

from loamgrid.plans.registry import FLAGSHIP, ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    value = lambda v: round(float(v), 6) if isinstance(v, float) else v
    return sorted(tuple(repr(value(r[i])) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{data}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, data, duck, name):
    df = QUERIES[name](spark, data)
    got = [tuple(r) for r in df.collect()]
    if name in ORACLES:
        twin = duck.sql(ORACLES[name])
        assert sorted(df.columns) == sorted(twin.columns)
        assert canonical(got, df.columns) == canonical(twin.fetchall(), list(twin.columns))
    else:
        assert got


def test_entry(spark):
    import __spark_entry__ as entry

    assert FLAGSHIP in entry.queries()
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
