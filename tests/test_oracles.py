"""Every capture query gives the rows of its SQL on the small tables."""

import duckdb
import pytest

from tickweave import catalog_queries, file_queries, storage_queries

MODULES = (catalog_queries, file_queries, storage_queries)
QUERIES, ORACLES = {k: v for m in MODULES for k, v in m.QUERIES.items()}, {k: v for m in MODULES for k, v in m.ORACLES.items()}
SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def _plain(v):
    return round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, db, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    cur = db.execute(ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    want = sorted((tuple(_plain(r[i]) for i in at) for r in cur.fetchall()), key=str)
    got = sorted((tuple(_plain(r[c]) for c in cols) for r in df.collect()), key=str)
    assert got == want


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
