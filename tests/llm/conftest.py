import os
import sys
from pathlib import Path

import duckdb
import pytest

# Python workers import the package by path
ROOT = str(Path(__file__).resolve().parents[2])
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def middle():
    return MIDDLE


@pytest.fixture(scope="session")
def twin():
    """DuckDB over the small tables."""
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SMALL}/{name}.parquet'")
    return con


@pytest.fixture
def documents(spark):
    """Builds a documents table from (doc_id, text) pairs, with other columns."""

    def build(rows):
        full = [(i, t, "en", "src", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")

    return build


@pytest.fixture
def odd_documents(spark):
    """Nulls, empty, long and repeated texts, repeated ids, and columns with clashing names."""
    long = " ".join(f"word{i % 977}" for i in range(30_000))
    rows = [
        (None, "a row without an id", "en", "x"),
        (None, None, None, None),
        (1, None, "en", "x"),
        (2, "", "en", "x"),
        (3, " \t\n ", "en", None),
        (4, long, "en", "x"),
        (5, long, "en", "y"),
        (6, "one two three four five six", "de", "y"),
        (6, "one two three four five six", "de", "y"),
        (7, "ONE two three four five six", None, "y"),
        (8, "ünï ködé ▁ text 漢字 \U0001f917", "fr", "z"),
        (9, "x", "en", "z"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    clashing = ("score", "held_out", "size", "kept", "component_id", "line", "h", "ids", "key", "node", "label", "rank")
    return df.selectExpr("*", "cast(length(text) as bigint) as n_chars", *[f"cast(1 as int) as {c}" for c in clashing])
