"""Every registered query against its SQL twin in DuckDB."""

import duckdb
import pytest
from conftest import SF

import __spark_entry__ as entry
from annalist.catalog import oracles, queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


def test_every_query_has_a_twin():
    assert set(queries.queries()) == set(oracles.oracle_sql())
    assert set(queries.queries()) <= set(entry.queries())
    assert set(oracles.oracle_sql()) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[-2:] == ["net_growth", "dynamism_score"] and df.count() > 0


def _normal(value):
    return round(value, 6) if isinstance(value, float) else value


@pytest.mark.parametrize("name", list(queries.queries()))
def test_query_equals_sql(spark, duck, name):
    df = queries.queries()[name](spark, SF)
    twin = duck.execute(oracles.oracle_sql()[name])
    columns = {d[0]: str(d[1]) for d in twin.description}
    assert {c: TYPES[t] for c, t in df.dtypes} == columns
    order = sorted(columns)
    expected = sorted(
        (tuple(_normal(dict(zip(columns, r))[c]) for c in order) for r in twin.fetchall()), key=repr
    )
    got = sorted((tuple(_normal(r[c]) for c in order) for r in df.collect()), key=repr)
    assert got == expected and got
