"""Each query against its DuckDB SQL, over the smallest tables."""

import os

import duckdb
import pytest

import syntenia.queries as q

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no driver tables")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(q.oracle_sql()))
def test_oracle(spark, db, name):
    df = q.QUERIES[name](spark, DIR)
    cols = sorted(df.columns)
    got = sorted(map(repr, (tuple(r[c] for c in cols) for r in df.collect())))
    rel = db.execute(q.ORACLES[name])
    names = [d[0] for d in rel.description]
    assert sorted(names) == cols
    order = [names.index(c) for c in cols]
    want = sorted(map(repr, (tuple(r[i] for i in order) for r in rel.fetchall())))
    assert got == want


@pytest.mark.parametrize("name", sorted(set(q.queries()) - set(q.oracle_sql())))
def test_runs(spark, name):
    assert q.QUERIES[name](spark, DIR).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
