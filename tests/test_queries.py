"""Every query of the library against its SQL in DuckDB."""

import os

import duckdb
import pytest

from tabulaire import process_queries, queries
from tests.conftest import DATA

QUERIES = queries.QUERIES | process_queries.QUERIES
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    got = QUERIES[name].run(spark, DATA)
    columns = sorted(got.columns)
    expected = duck.sql(QUERIES[name].sql)
    assert sorted(expected.columns) == columns
    order = lambda rows: sorted(map(str, rows))
    assert order(tuple(r) for r in got.select(columns).collect()) == order(expected.select(*columns).fetchall())


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
