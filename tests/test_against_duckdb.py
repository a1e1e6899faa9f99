"""Every registered query against its check SQL, on the same tables."""

import math

import duckdb
import pytest

from vitals.plans.check_sql import CHECK_SQL
from vitals.plans.registry import QUERIES

TABLES = ["events"]
KEYS = sorted(QUERIES)


def normalized(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value)
    return str(value)


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normalized(row[i]) for i in order) for row in rows)


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    yield connection
    connection.close()


def test_every_query_has_check_sql():
    assert set(QUERIES) == set(CHECK_SQL)


DUCK_TYPES = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


@pytest.mark.parametrize("key", KEYS)
def test_query_matches(spark, duck, sf_dir, key):
    frame = QUERIES[key](spark, sf_dir)
    relation = duck.sql(CHECK_SQL[key])
    types = {name: str(kind) for name, kind in zip(relation.columns, relation.types)}
    assert {n: DUCK_TYPES[t] for n, t in frame.dtypes} == types
    expected = as_rows(relation.columns, relation.fetchall())
    actual = as_rows(frame.columns, [tuple(r) for r in frame.collect()])
    assert len(actual) == len(expected)
    assert actual == expected
    if not sf_dir.endswith("sf0.001"):
        assert actual, "an empty result proves nothing"
