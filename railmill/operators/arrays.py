"""Arrays of structs: unnest, look up, join in lock-step, extend."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a costly column, such as parsed JSON, that is evaluated once per row.

    A filter on a plain column is moved below it and repeats its expression there. The
    value is emitted as a one-element unnest instead, which filters stay above of.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def unnest(df: DataFrame, column: str) -> DataFrame:
    """One row per struct with its fields as columns; an empty array drops the row."""
    others = [F.col(c) for c in df.columns if c != column]
    return df.select(*others, F.inline(column))


def json_array_rows(df: DataFrame, column: str, position: str, value: str) -> DataFrame:
    """One row per element of a JSON array, with its 0-based position and JSON text."""
    return df.select("*", F.posexplode(F.from_json(column, "array<string>")).alias(position, value))


def coordinates(path: Column) -> Column:
    """Array of points as (longitude, latitude) pairs."""
    return F.transform(path, lambda p: F.struct(p["longitude"].alias("longitude"), p["latitude"].alias("latitude")))


def expand_parallel(df: DataFrame, arrays: list[str], names: list[str]) -> DataFrame:
    """Parallel arrays to rows."""
    others = [F.col(c) for c in df.columns if c not in arrays]
    zipped = F.arrays_zip(*[F.col(a).alias(n) for a, n in zip(arrays, names)])
    return df.select(*others, F.inline(zipped).alias(*names))


def append_capped(array: Column, item: Column, cap: int) -> Column:
    """Array plus one element, keeping the last ``cap``."""
    longer = F.concat(array, F.array(item))
    return F.slice(longer, -F.least(F.size(longer), F.lit(cap)), F.lit(cap))


def first_match(items: Column, test) -> Column:
    """First struct of an array a predicate holds for, or null."""
    return F.try_element_at(F.filter(items, test), F.lit(1))
