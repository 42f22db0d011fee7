"""Every catalogue query against its SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__
from ledgerline.plans.queries import QUERIES, SQL


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    return [plain(x) for x in v] if isinstance(v, (list, tuple)) else v


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for path in glob.glob(f"{small}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from read_parquet('{path}')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, small, duck, name):
    df = QUERIES[name](spark, small)
    names = sorted(df.columns)
    rows = sorted(repr([plain(x) for x in r]) for r in df.select(*names).collect())
    if name not in SQL:
        return
    found = duck.execute(SQL[name])
    have = [c[0] for c in found.description]
    assert sorted(have) == names
    order = [have.index(n) for n in names]
    assert rows == sorted(repr([plain(r[i]) for i in order]) for r in found.fetchall())


def test_entry_points(spark):
    df = __spark_entry__.entry(spark)
    assert df.count() > 0 and df.columns == ["vendor", "total", "n"]
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
