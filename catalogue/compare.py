"""Runs a query in Spark and its twin in DuckDB and compares names, types and values."""

from __future__ import annotations

import duckdb
from pyspark.sql import SparkSession

from catalogue.registry import ORACLE, QUERIES
from catalogue.roles import BASE_TABLES

TYPES = {
    "string": {"VARCHAR"},
    "bigint": {"BIGINT"},
    "int": {"INTEGER"},
    "double": {"DOUBLE"},
    "boolean": {"BOOLEAN"},
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in BASE_TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _rows(rows, positions) -> list[tuple]:
    return sorted((tuple(r[i] for i in positions) for r in rows), key=repr)


def compare(spark: SparkSession, con: duckdb.DuckDBPyConnection, name: str, sf_dir: str) -> list[str]:
    """Problems found; empty when both sides agree. Without a twin only the run is checked."""
    df = QUERIES[name](spark, sf_dir)
    rows = df.collect()
    problems = [] if rows else ["no rows"]
    if name not in ORACLE:
        return problems
    expected = con.sql(ORACLE[name])
    types = dict(zip(expected.columns, map(str, expected.types)))
    if sorted(df.columns) != sorted(expected.columns):
        return [f"columns {sorted(df.columns)} != {sorted(expected.columns)}"]
    for field in df.schema.fields:
        kind = field.dataType.simpleString()
        if types[field.name] not in TYPES.get(kind, {kind}):
            problems.append(f"type of {field.name}: {kind} != {types[field.name]}")
    names = sorted(df.columns)
    got = _rows(rows, [df.columns.index(c) for c in names])
    want = _rows(expected.fetchall(), [expected.columns.index(c) for c in names])
    if len(got) != len(want):
        problems.append(f"rows {len(got)} != {len(want)}")
    elif got != want:
        a, b = next((a, b) for a, b in zip(got, want) if a != b)
        problems.append(f"values: {dict(zip(names, a))} != {dict(zip(names, b))}")
    return problems
