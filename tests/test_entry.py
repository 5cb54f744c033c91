"""Every query against its SQL on the smallest tables."""

import glob
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables here")
CORE = [n for n, q in entry.queries().items() if ".llm" not in q.__module__]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET timezone='UTC'")
    for p in glob.glob(f"{DATA}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


def _rows(rows):
    return Counter(repr([round(v, 4) if isinstance(v, float) else v for v in r]) for r in rows)


@pytest.mark.parametrize("name", CORE)
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, DATA)
    cols = sorted(df.columns)
    got = df.select(*cols).collect()
    sql = entry.oracle_sql().get(name)
    if sql:
        want = duck.sql(f"SELECT {', '.join(cols)} FROM ({sql})").fetchall()
        assert _rows(got) == _rows(want)


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
