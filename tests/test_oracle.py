"""Every registered query against its SQL, on the smallest tables."""

import duckdb
import pytest
from catalog.oracle import ORACLE
from catalog.queries import REGISTRY

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
SQL_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck(tiny):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tiny}/{table}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(REGISTRY) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_sql(spark, duck, tiny, name):
    df = REGISTRY[name](spark, tiny)
    columns = sorted(df.columns)
    relation = duck.sql(ORACLE[name])
    assert sorted(relation.columns) == columns
    types = dict(zip(relation.columns, map(str, relation.types)))
    assert {c: SQL_TYPES[t] for c, t in df.dtypes} == types
    got = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    at = [relation.columns.index(c) for c in columns]
    want = sorted(repr(tuple(r[i] for i in at)) for r in relation.fetchall())
    assert got == want
