"""Joins beyond a plain equi-join, and Unknown member rows.

Nothing here forces a broadcast. Small dimensions are broadcast by Spark after it has
seen their size; larger ones are shuffled and a hot key is split by the skew join that
``session.apply_defaults`` switches on.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railmill.functions.keys import unknown_key
from railmill.operators.dedup import first_k, remaining_order


def equal_on(left: str, right: str, pairs: list[tuple[str, str]]) -> Column:
    """Conjunction of ``left.a = right.b``; null never matches."""
    terms = [F.col(f"{left}.{a}") == F.col(f"{right}.{b}") for a, b in pairs]
    return reduce(lambda a, b: a & b, terms)


def or_unknown(key: Column) -> Column:
    """Foreign key, or the key of the Unknown member where the lookup missed."""
    return F.coalesce(key, unknown_key())


def with_unknown_member(dim: DataFrame, member: dict[str, object]) -> DataFrame:
    """Dimension plus one Unknown row; columns not in ``member`` are null."""
    row = dim.sparkSession.range(1).select(
        *[
            (value if isinstance(value, Column) else F.lit(value)).cast(f.dataType).alias(f.name)
            for f in dim.schema.fields
            for value in [member.get(f.name)]
        ]
    )
    return dim.unionByName(row)


def in_two_roles(
    fact: DataFrame, dim: DataFrame, on: tuple[str, str], key: str, columns: dict[str, tuple[str, str]]
) -> DataFrame:
    """Left join of one dimension under two roles.

    ``on`` holds the two fact columns, ``columns`` maps each dimension column to its
    name in the first and in the second role.
    """
    out = fact
    for role, fact_column in enumerate(on):
        names = {c: pair[role] for c, pair in columns.items()}
        side = dim.select(F.col(key).alias("_role_key"), *[F.col(c).alias(n) for c, n in names.items()])
        out = out.join(side, out[fact_column] == side["_role_key"], "left").drop("_role_key")
    return out


def _bin(day: Column, width: int) -> Column:
    return F.floor(F.unix_date(day) / F.lit(width))


def interval_join(
    points: DataFrame,
    ranges: DataFrame,
    keys: list[tuple[str, str]],
    point: Column,
    start: str,
    end: str,
    bin_days: int = 28,
) -> DataFrame:
    """Rows of ``points`` with every row of ``ranges`` of equal keys whose dates cover ``point``.

    Ranges are laid out over calendar bins and the bin joins the equi key. A hot key is
    thereby spread over its bins, and a point meets only ranges that reach its bin.
    Bins outside the span of the points are not laid out, so open-ended ranges stay cheap.
    """
    left = points.withColumn("_day", point).withColumn("_bin", _bin(F.col("_day"), bin_days))
    span = points.select(_bin(point, bin_days).alias("b"))
    low = span.select(F.min("b")).scalar()
    high = span.select(F.max("b")).scalar()
    from_bin = F.greatest(_bin(F.col(start), bin_days), low)
    to_bin = F.least(_bin(F.col(end), bin_days), high)
    right = (
        ranges.filter(F.col(start) <= F.col(end))
        .withColumn("_from", from_bin)
        .withColumn("_to", to_bin)
        .filter(F.col("_from") <= F.col("_to"))
        .withColumn("_range_bin", F.explode(F.sequence("_from", "_to")))
        .drop("_from", "_to")
    )
    condition = (
        equal_on("p", "r", keys)
        & (F.col("p._bin") == F.col("r._range_bin"))
        & F.col("p._day").between(F.col(f"r.{start}"), F.col(f"r.{end}"))
    )
    return left.alias("p").join(right.alias("r"), condition, "inner").drop("_day", "_bin", "_range_bin")


def valid_on(ranges: DataFrame, key: str, day: dt.date, start: str, end: str, order: list[Column]) -> DataFrame:
    """One row per key: the first in ``order`` among those whose dates cover ``day``."""
    current = ranges.filter((F.col(start) <= F.lit(day)) & (F.col(end) >= F.lit(day)) & F.col(key).isNotNull())
    return first_k(current, [key], [*order, *remaining_order(current, {key})], 1)


def append_missing(primary: DataFrame, fallback: DataFrame, key: str) -> DataFrame:
    """All of ``primary`` plus the rows of ``fallback`` whose key it lacks.

    Columns only one side has are null on the other, so either side may be empty.
    """
    known = primary.select(key).filter(F.col(key).isNotNull())
    extra = fallback.join(known, key, "left_anti")
    return primary.unionByName(extra, allowMissingColumns=True)


def upsert(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Target with its rows replaced or extended by ``updates`` (one row per key)."""
    return target.join(updates.select(*keys), keys, "left_anti").unionByName(updates)
