"""Every registered query that has an SQL form gives its rows."""

import duckdb
import pytest
from conftest import SF

from dyelake.plans.all_queries import ORACLE_SQL, QUERIES

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings")


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(([round(v, 6) if isinstance(v, float) else v for v in (r[i] for i in order)] for r in values), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF)
    found = [tuple(r) for r in got.collect()]
    if name in ORACLE_SQL:
        want = duck.execute(ORACLE_SQL[name])
        columns = [c[0] for c in want.description]
        assert sorted(got.columns) == sorted(columns)
        assert rows(got.columns, found) == rows(columns, want.fetchall())
