"""Every registered query against its SQL, run by DuckDB on the same tables."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_points
from cadastre.plans.queries import ORACLE, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, duck, name):
    df = entry_points.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    cursor = duck.execute(entry_points.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    want = Counter(repr(tuple(r[i] for i in places)) for r in cursor.fetchall())
    got = Counter(repr(tuple(r[c] for c in columns)) for r in df.collect())
    assert got == want
    assert want, "a query without rows checks nothing"


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
