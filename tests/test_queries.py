"""Every registered query of the engine against its SQL, and the entry point."""

import glob
import os

import duckdb
import pytest

import __spark_entry__
from tagloom.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


def plain(v):
    if v is None or v != v:
        return None
    if isinstance(v, float):
        return round(v, 9)
    return str(v)[:19] if hasattr(v, "isoformat") else v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted((tuple(plain(r[k]) for k in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query(spark, db, name):
    df = catalog.QUERIES[name](spark, SF)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = db.execute(catalog.ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(df.columns) == sorted(columns)
    want = rows_of(columns, result.fetchall())
    same = lambda v: float(v) if isinstance(v, int) and not isinstance(v, bool) else v
    assert [tuple(map(same, r)) for r in got] == [tuple(map(same, r)) for r in want]


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLES)))
def test_runs(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
