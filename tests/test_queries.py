"""Every registered query of the engine against its SQL in DuckDB, on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from tejido import queries as engine

SF = "/root/testdata/sf0.001"
NAMES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for n in NAMES:
        c.sql(f"CREATE VIEW {n} AS SELECT * FROM '{SF}/{n}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v


@pytest.mark.parametrize("name", sorted(engine.queries()))
def test_same_rows(spark, db, name):
    df = engine.queries()[name](spark, SF)
    rows, names = df.collect(), sorted(df.columns)
    sql = engine.oracle_sql().get(name)
    if sql is None:
        assert rows is not None
        return
    want = db.sql(sql)
    assert sorted(want.columns) == names
    order = [want.columns.index(c) for c in names]
    assert sorted((tuple(plain(r[c]) for c in names) for r in rows), key=repr) == sorted((tuple(plain(r[i]) for i in order) for r in want.fetchall()), key=repr)


def test_registry_is_whole():
    assert set(engine.oracle_sql()) <= set(engine.queries()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
