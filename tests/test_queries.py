"""Every core query against its SQL on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from bondlake.plans.catalogue import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for p in os.listdir(DATA):
        c.execute(f"create view {p.split('.')[0]} as select * from read_parquet('{DATA}/{p}')")
    return c


def canon(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return [canon(x) for x in v]
    return v


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, db, name):
    df = QUERIES[name](spark, DATA)
    cur = db.execute(ORACLES[name])
    cols = [x[0] for x in cur.description]
    assert sorted(df.columns) == sorted(cols)
    got = sorted(str([canon(r[c]) for c in sorted(cols)]) for r in df.collect())
    want = sorted(str([canon(dict(zip(cols, r, strict=True))[c]) for c in sorted(cols)]) for r in cur.fetchall())
    assert got == want


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    QUERIES[name](spark, DATA).collect()
