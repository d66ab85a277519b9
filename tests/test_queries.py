"""Every registered query of the engine against its SQL on the smallest driver tables."""

import datetime as dt
import math
import os

import duckdb
import pytest

from listwright.plans import registry

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="driver tables are missing")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DATA}/{f}'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return str(v) if isinstance(v, dt.date) else v


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, db, name):
    df = registry.QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    own = [tuple(plain(v) for v in r) for r in df.select(*columns).collect()]
    if name not in registry.ORACLE_SQL:
        assert own
        return
    got = db.execute(registry.ORACLE_SQL[name])
    names = [c[0] for c in got.description]
    assert sorted(names) == columns
    expected = [tuple(plain(r[names.index(c)]) for c in columns) for r in got.fetchall()]
    assert sorted(own, key=str) == sorted(expected, key=str)
