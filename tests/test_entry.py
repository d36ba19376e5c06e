"""Registered queries against their SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__
from ledgerlake.plans.catalog import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"


def plain(v):
    if isinstance(v, float):
        return float(f"{v:.9g}")
    return str(v) if hasattr(v, "isoformat") else v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{f}')")
    return c


def test_contract(spark):
    assert set(ORACLE_SQL) <= set(QUERIES) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    if name in ORACLE_SQL:
        answer = con.execute(ORACLE_SQL[name])
        names = [d[0] for d in answer.description]
        assert sorted(names) == cols
        assert got == sorted((tuple(plain(r[names.index(c)]) for c in cols) for r in answer.fetchall()), key=repr)
