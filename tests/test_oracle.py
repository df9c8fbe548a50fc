"""Every registered key against its DuckDB twin on the smallest driver tables (sf0.001),
with the same compare the driver uses: sorted column names, row count, order-insensitive
value hash."""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from labelgraph.plans.catalog import ORACLE, QUERIES
from labelgraph.plans.fixtures import TABLES

KEYS = sorted(ORACLE)


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        return repr(round(v, 9))
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha1("\n".join(sorted("\x1f".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert _digest(df.columns, srows) == _digest(ocols, orows)


def test_every_key_registered():
    q = E.queries()
    assert len(q) >= 80
    missing = set(E.oracle_sql()) - set(q)
    assert not missing


def test_entry_runs(spark):
    df = E.entry(spark)
    assert set(df.columns) == {"part", "key", "instruction", "output"}
    assert df.count() > 0


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_keys_run(spark, key):
    assert E.queries()[key](spark, SF_SMALL).count() >= 0
