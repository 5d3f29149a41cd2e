"""One row per key.

Every variant is ``row_number() = 1`` (or ``<= k``) directly under a filter, which
Spark evaluates per map task before the shuffle: a key that holds a third of the table
sends one row per task, not its whole group, to the task that decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _as_columns(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def remaining_order(df: DataFrame, used: set[str]) -> list[Column]:
    """Descending order over all columns not in ``used``: makes any order total."""
    return [F.col(f"`{f.name}`").desc_nulls_last() for f in df.schema.fields if f.name not in used]


def first_k(df: DataFrame, keys, order, k: int, rank_as: str | None = None) -> DataFrame:
    """The first ``k`` rows per key in ``order``."""
    window = Window.partitionBy(*_as_columns(keys)).orderBy(*_as_columns(order))
    name = rank_as or "_rank"
    kept = df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= k)
    return kept if rank_as else kept.drop(name)


def keep_first(df: DataFrame, keys, order, ordered_by: set[str] = frozenset()) -> DataFrame:
    """One row per key: the first in ``order``; ties go to the greatest remaining columns.

    ``ordered_by`` names the columns ``order`` has dealt with already.
    """
    used = {c for c in keys if isinstance(c, str)} | ordered_by
    return first_k(df, keys, [*_as_columns(order), *remaining_order(df, used)], 1)


def keep_latest(df: DataFrame, keys, by: str = "ingest_ts") -> DataFrame:
    """One row per key: the one with the greatest ``by``."""
    return keep_first(df, keys, [F.col(by).desc_nulls_last()], {by})


def keep_any(df: DataFrame, keys, newest: str = "ingest_ts") -> DataFrame:
    """One row per key where the source does not say which.

    Repeatable all the same: the newest row wins, then the greatest remaining columns.
    """
    order = [F.col(newest).desc_nulls_last()] if newest in df.columns else []
    return keep_first(df, keys, order, {newest})


def keep_by_priority(df: DataFrame, keys, source: str, ranking: list[str]) -> DataFrame:
    """One row per key: the source that comes first in ``ranking`` (unlisted ones last)."""
    rank = F.lit(len(ranking))
    for position, name in reversed(list(enumerate(ranking))):
        rank = F.when(F.col(source) == name, F.lit(position)).otherwise(rank)
    return keep_first(df, keys, [rank.asc()])


def first_and_last(df: DataFrame, keys, order: list[str], fields: dict[str, tuple[str, str]]) -> DataFrame:
    """First and last row per key in one pass.

    ``fields`` maps a source column to its (first, last) output names. ``min_by`` and
    ``max_by`` combine before the shuffle, so no group is gathered; for text fields Spark sorts each task's rows.
    """
    position = F.struct(*order, *fields)
    values = F.struct(*fields)
    ends = df.groupBy(*keys).agg(F.min_by(values, position).alias("_a"), F.max_by(values, position).alias("_z"))
    firsts = [F.col(f"_a.{c}").alias(names[0]) for c, names in fields.items()]
    lasts = [F.col(f"_z.{c}").alias(names[1]) for c, names in fields.items()]
    return ends.select(*keys, *firsts, *lasts)
