"""Every registered query against its DuckDB oracle (sf0.001 fixture)."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else round(v, 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def _key(r):
    return tuple((x is None, str(x)) for x in r)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    cols = sorted(sdf.columns)
    srows = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=_key)
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    order = sorted(range(len(dcols)), key=lambda i: dcols[i])
    drows = sorted((tuple(_norm(r[i]) for i in order) for r in res.fetchall()), key=_key)
    assert cols == sorted(dcols)
    assert len(srows) == len(drows)
    assert srows == drows


def test_every_query_has_builder(spark):
    qs = E.queries()
    assert set(E.oracle_sql()) <= set(qs)
    for name in set(qs) - set(E.oracle_sql()):
        df = qs[name](spark, SF_SMALL)
        assert df.count() >= 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "event_count" in df.columns
