"""Every query against its SQL over the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
NAMES = [n for n in entry.queries() if not n.startswith("op") and n != "pipeline"]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(x):
    return round(x, 9) if isinstance(x, float) else x


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    assert got
    if name in entry.oracle_sql():
        out = con.execute(entry.oracle_sql()[name])
        names = [d[0] for d in out.description]
        assert sorted(names) == columns
        assert got == sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in out.fetchall()), key=str)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
