"""Every query with SQL against DuckDB on the smallest tables."""

import duckdb
import pytest

from ladderlake.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def same(spark, con, queries, name):
    got = queries.QUERIES[name](spark, SF)
    columns = sorted(got.columns)
    want = con.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == columns
    rows = [tuple(dict(zip(names, r))[c] for c in columns) for r in want.fetchall()]
    assert rows
    norm = lambda r: tuple(float(x) if x.__class__.__name__ == "Decimal" else x for x in r)
    assert sorted(map(norm, map(tuple, got.select(*columns).collect())), key=str) == sorted(map(norm, rows), key=str)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, con, name):
    same(spark, con, catalogue, name)
