"""Every catalogue query with SQL against DuckDB on a small scale."""

import os

import duckdb
import pytest

from spotlattice import catalogue

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no fixture tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def rounded(rows):
    return sorted((tuple(round(x, 4) + 0.0 if isinstance(x, float) else x for x in r) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_query_matches_sql(spark, duck, name):
    got = catalogue.QUERIES[name](spark, DATA)
    names = sorted(got.columns)
    want = duck.execute(f"SELECT {', '.join(f'"{c}"' for c in names)} FROM ({catalogue.SQL[name]})").fetchall()
    own = [tuple(r) for r in got.select(*names).collect()]
    assert len(own) == len(want)
    for a, b in zip(rounded(own), rounded(want), strict=True):
        assert all(x == y or (isinstance(x, float) and abs(x - y) <= 2e-4 * (1 + abs(y))) for x, y in zip(a, b, strict=True)), (a, b)


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - set(catalogue.SQL)))
def test_query_without_sql_runs(spark, name):
    assert catalogue.QUERIES[name](spark, DATA).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
