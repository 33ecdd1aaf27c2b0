"""Every registered query against its SQL on the given tables."""

import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from mercadal.oracles import ORACLES
from mercadal.plans.table_queries import ALL_TABLES, QUERIES

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
TABLES = ALL_TABLES


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def normal(value):
    if value is None:
        return "~"
    if isinstance(value, float):
        return f"{value:.9g}"
    return str(value)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(row[i]) for i in order) for row in rows)


def kind(name):
    name = name.lower()
    for known in ("bigint", "int", "double", "decimal", "boolean", "date", "timestamp"):
        if name.startswith(known):
            return known
    return {"varchar": "string"}.get(name, name)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    result = queries()[name](spark, FOLDER)
    rows = [tuple(row) for row in result.collect()]
    relation = duck.sql(oracle_sql()[name])
    expected = relation.fetchall()
    assert sorted(result.columns) == sorted(relation.columns)
    assert len(rows) == len(expected)
    assert canonical(result.columns, rows) == canonical(relation.columns, expected)
    ours = {f.name: kind(f.dataType.simpleString()) for f in result.schema.fields}
    theirs = {
        c: kind(str(t)).replace("integer", "int")
        for c, t in zip(relation.columns, relation.types, strict=True)
    }
    ours = {k: v.replace("timestamp_ntz", "timestamp") for k, v in ours.items()}
    assert ours == theirs


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(oracle_sql()) <= set(queries())


def test_entry(spark):
    result = entry(spark)
    assert result.count() > 0
    assert "ingresos_totales" in result.columns
