"""Every registered query against its SQL on the smallest tables; the registry's form."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from editlume.session import release_scratch, scratch_root

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def canon(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6g}"
    return str(v)


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{SF}/{f}')")
    return con


def test_registry():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert all(f"p{n}_found" in entry.queries() for n in (1, 2, 4, 5, 6))


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, db, name):
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(canon(r[c]) for c in cols) for r in df.collect())
    release_scratch(spark)
    left = os.path.join(scratch_root(spark).removeprefix("file://"), "editlume")
    assert not os.path.isdir(left) or not os.listdir(left)
    res = db.execute(entry.oracle_sql()[name])
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    assert got == sorted(tuple(canon(r[names.index(c)]) for c in cols) for r in res.fetchall())
