import glob
import os

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def plain(v):
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(plain(x) for x in v)
    if v is None or v != v:
        return None
    return float(f"{v:.9g}") if isinstance(v, float) else int(v) if isinstance(v, (int, np.integer)) and not isinstance(v, bool) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in glob.glob(FOLDER + "/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


def test_entry_runs(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    got = entry.queries()[name](spark, FOLDER)
    want = duck.sql(entry.oracle_sql()[name])
    cols = sorted(got.columns)
    assert cols == sorted(want.columns)
    a = sorted(repr(tuple(plain(r[c]) for c in cols)) for r in got.collect())
    at = [want.columns.index(c) for c in cols]
    b = sorted(repr(tuple(plain(r[i]) for i in at)) for r in want.fetchall())
    assert a == b
