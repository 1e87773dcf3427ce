"""Every registered query against its check SQL on the smallest test tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as contract

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
SQL_TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}
LIBRARY = contract.queries().keys() - contract.LLM_QUERIES.keys()
QUERIES = {name: contract.queries()[name] for name in LIBRARY}
ORACLE = {name: sql for name, sql in contract.oracle_sql().items() if name in LIBRARY}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _sorted(rows):
    return sorted((tuple(row) for row in rows), key=lambda row: [(v is None, str(v)) for v in row])


def test_every_query_has_check_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_check_sql(spark, sf_dir, duck, name):
    result = QUERIES[name](spark, sf_dir)
    columns = sorted(result.columns)
    expected = duck.sql(ORACLE[name])
    types = {col: str(kind) for col, kind in zip(expected.columns, expected.types)}
    assert {col: SQL_TYPES[kind] for col, kind in result.dtypes} == types
    shown = ", ".join(f'"{col}"' for col in columns)
    want = duck.sql(f"SELECT {shown} FROM ({ORACLE[name]})").fetchall()
    assert _sorted(result.select(*columns).collect()) == _sorted(want)


def test_entry(spark):
    row = contract.entry(spark).collect()[0]
    assert row["sessions"] > 0
