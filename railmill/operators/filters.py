"""Reusable predicates. Times are parameters; nothing reads the clock."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railmill.functions.labels import LIVE_STALE_MINUTES


def record_type(df: DataFrame, name: str) -> DataFrame:
    return df.filter(F.col("record_type") == name)


def latest_partition(df: DataFrame, day: Column, source: DataFrame | None = None) -> DataFrame:
    """Rows of the newest day, found by a scalar subquery.

    Where ``day`` is the partition column the subquery prunes the scan.
    """
    newest = (source if source is not None else df).select(F.max(day)).scalar()
    return df.filter(day == newest)


def on_run_date(df: DataFrame, run_date: dt.date, lookback_days: int = 0, column: str = "ingest_date") -> DataFrame:
    """Incremental scan: the partitions of the run day and of ``lookback_days`` before it."""
    first = run_date - dt.timedelta(days=lookback_days)
    return df.filter(F.col(column).between(F.lit(first), F.lit(run_date)))


def optional_equals(df: DataFrame, column: str, value: object | None) -> DataFrame:
    """Equality filter that is absent when no value is given."""
    return df if value is None else df.filter(F.col(column) == F.lit(value))


def facet_filter(df: DataFrame, facets: Mapping[str, Sequence[object]]) -> DataFrame:
    """Multi-value filters; an empty choice does not filter."""
    for column, chosen in facets.items():
        if chosen:
            df = df.filter(F.col(column).isin(list(chosen)))
    return df


def within(ts: Column, around: dt.datetime, span: dt.timedelta) -> Column:
    """Inclusive window of ``span`` on either side of a moment."""
    return ts.between(F.lit(around - span), F.lit(around + span))


def at_or_approaching(df: DataFrame, station: str, here="location_name", ahead="next_station") -> DataFrame:
    """Trains at a station or heading for it; ``All`` keeps every row."""
    if station == "All":
        return df
    return df.filter((F.col(here) == station) | (F.col(ahead) == station))


def not_stale(df: DataFrame, as_of: dt.datetime, column="last_update", minutes: int = LIVE_STALE_MINUTES) -> DataFrame:
    """Rows updated within the last minutes before ``as_of``."""
    return df.filter(F.col(column) >= F.lit(as_of - dt.timedelta(minutes=minutes)))


def member_of(df: DataFrame, column: str, listed: DataFrame, listed_column: str) -> DataFrame:
    """Rows whose value occurs in another frame."""
    names = listed.select(F.col(listed_column).alias(column))
    return df.join(names, column, "left_semi")
