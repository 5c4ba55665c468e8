"""The driver contract, and a sample of queries against their SQL."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

DIR = "/root/testdata/sf0.001"
NAMES = [n for n in entry.queries() if not n.startswith("op") and n != "pipeline"]


def oracle(sql):
    c = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents".split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    cur = c.execute(sql)
    return [d[0] for d in cur.description], cur.fetchall()


@pytest.mark.skipif(not os.path.isdir(DIR), reason="needs the test tables")
@pytest.mark.parametrize("name", [n for n in NAMES if n in entry.oracle_sql()])
def test_query_equals_oracle(spark, name):
    df = entry.queries()[name](spark, DIR)
    cols, want = oracle(entry.oracle_sql()[name])
    assert sorted(cols) == sorted(df.columns)
    got = sorted(map(repr, (tuple(r) for r in df.select(*cols).collect())))
    assert got == sorted(map(repr, want))


def test_entry(spark):
    assert entry.entry(spark).count() > 0
