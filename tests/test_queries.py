"""Every named query of the engine against its SQL, over the smallest tables."""

import os

import duckdb
import pytest

from stratadoc.plans import catalogue

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{SF}/{f}')")
    return con


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    value = lambda v: round(v, 8) if isinstance(v, float) else v
    return sorted((tuple(value(r[i]) for i in order) for r in data), key=repr)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE))
def test_query(spark, db, name):
    got = catalogue.QUERIES[name](spark, SF)
    want = db.execute(catalogue.ORACLE[name])
    columns = [d[0] for d in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(columns, want.fetchall())


def test_every_query_is_known():
    assert set(catalogue.ORACLE) <= set(catalogue.QUERIES)
    import __spark_entry__

    assert set(catalogue.QUERIES) <= set(__spark_entry__.queries())
