"""Every query against its SQL on the smallest tables, and the driver contract."""

import glob
import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__
from sessionloom.plans import pipelines, problems, reference

MODULES = [problems, reference, pipelines]


@pytest.fixture(scope="module")
def duck(tiny):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{tiny}/*.parquet"):
        connection.execute(f"create view {os.path.basename(path)[:-8]} as select * from read_parquet('{path}')")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if hasattr(value, "as_tuple"):
        return round(float(value), 6)
    if isinstance(value, list):
        return tuple(map(plain, value))
    return value.replace(tzinfo=None) if getattr(value, "tzinfo", None) else value


@pytest.mark.parametrize("name", [n for m in MODULES for n in m.QUERIES])
def test_query(spark, duck, tiny, name):
    module = next(m for m in MODULES if name in m.QUERIES)
    df = module.QUERIES[name](spark, tiny)
    columns = sorted(df.columns)
    got = Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
    if name in module.ORACLE:
        cursor = duck.execute(module.ORACLE[name])
        names = [d[0] for d in cursor.description]
        assert sorted(names) == columns
        assert got == Counter(tuple(plain(r[names.index(c)]) for c in columns) for r in cursor.fetchall())


def test_contract(spark):
    queries, oracle = __spark_entry__.queries(), __spark_entry__.oracle_sql()
    assert set(oracle) <= set(queries)
    assert __spark_entry__.entry(spark).count() > 0
