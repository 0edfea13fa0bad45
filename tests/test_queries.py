"""Every registered query against its SQL on the smallest scale."""

import math

import duckdb
import pytest

import __spark_entry__ as driver
from workload.common import TABLES

SF = "/root/testdata/sf0.001"
CORE = {name for part in driver.CORE for name in part.QUERIES}
QUERIES = {name: query for name, query in driver.queries().items() if name in CORE}
ORACLES = {name: sql for name, sql in driver.oracle_sql().items() if name in CORE}


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(map(plain, v))
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_keys():
    assert set(QUERIES) == set(ORACLES) and len(QUERIES) > 100


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cur = duck.execute(ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    order = sorted(names)
    got = sorted((tuple(plain(r[c]) for c in order) for r in df.collect()), key=repr)
    want = sorted((tuple(plain(r[names.index(c)]) for c in order) for r in cur.fetchall()), key=repr)
    assert got == want


def test_entry(spark):
    assert driver.entry(spark).count() == 4
