"""Every query against DuckDB on the same tables: same columns, types and rows."""


import duckdb
import pytest

import __spark_entry__ as contract
from orderloom.testbed.oracle import ORACLE
from orderloom.testbed.queries import QUERIES
from tests.conftest import SF_CHECK

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()
# Spark type to the name DuckDB gives the same type.
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_CHECK}/{name}.parquet'")
    return connection


def _sortable(row):
    return [(value is None, value if value is not None else 0) for value in row]


def test_keys_agree():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("key", sorted(contract.oracle_sql()))
def test_query(spark, duck, key):
    got = contract.queries()[key](spark, SF_CHECK)
    columns = sorted(got.columns)
    rows = [tuple(row) for row in got.select(*columns).collect()]
    sql = contract.oracle_sql()[key]
    described = {row[0]: row[1] for row in duck.execute(f"DESCRIBE {sql}").fetchall()}
    names = ", ".join(f'"{name}"' for name in columns)
    want = duck.execute(f"SELECT {names} FROM ({sql})").fetchall()
    assert columns == sorted(described)
    assert {f.name: TYPES[f.dataType.simpleString()] for f in got.schema.fields} == described
    rows.sort(key=_sortable)
    want.sort(key=_sortable)
    assert len(rows) == len(want) > 0
    different = [(a, b) for a, b in zip(rows, want) if a != b]
    assert not different, different[:3]


def test_entry(spark):
    assert contract.entry(spark).count() == 10
