"""Times of day, service dates, weekday rules and delay buckets."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from railmill.functions.labels import DAY_FLAGS, DELAY_BUCKETS


def hhmm_time(col: Column) -> Column:
    """``HHMM`` (a trailing half-minute mark is dropped) to ``HH:mm:ss``; else null."""
    valid = col.rlike("^([01][0-9]|2[0-3])[0-5][0-9]")
    return F.when(valid, F.concat(F.substring(col, 1, 2), F.lit(":"), F.substring(col, 3, 2), F.lit(":00")))


def allowance_minutes(col: Column) -> Column:
    """Allowance code to minutes: ``H`` is half a minute, alone or after one digit."""
    return (
        F.when(col == "H", F.lit(0.5))
        .when(col.rlike("^[0-9]{1,2}$"), col.try_cast("double"))
        .when(col.rlike("^[0-9]H$"), F.substring(col, 1, 1).try_cast("double") + 0.5)
    )


def at_time_of_day(day: Column, *times: Column) -> Column:
    """Timestamp of the first known time of day on a date."""
    return F.to_timestamp(F.concat(day.cast("string"), F.lit(" "), F.coalesce(*times)))


def service_date(col: Column) -> Column:
    return F.to_date(col)


def weekday_number(col: Column) -> Column:
    """1 for Sunday to 7 for Saturday."""
    return F.dayofweek(col)


def runs_on(day: dt.date, start: str, end: str) -> Column:
    """Rows whose validity covers ``day`` and whose flag for that weekday is set.

    The weekday is known when the plan is built, so the predicate is three plain
    comparisons that reach the scan.
    """
    day_col = F.lit(day)
    return (F.col(start) <= day_col) & (F.col(end) >= day_col) & F.col(DAY_FLAGS[day.weekday()])


def runs_on_column(day: Column, start: Column, end: Column, flags: list[Column]) -> Column:
    """As ``runs_on`` for a date that differs per row; ``flags`` run Monday to Sunday."""
    position = (F.dayofweek(day) + F.lit(5)) % F.lit(7) + F.lit(1)
    return day.between(start, end) & F.element_at(F.array(*flags), position)


def delay_bucket(minutes: Column) -> Column:
    """Delay class in whole minutes; a missing variation counts as the worst class."""
    on_time, slight, late, major = DELAY_BUCKETS
    return (
        F.when(minutes <= 0, on_time)
        .when(minutes.between(1, 5), slight)
        .when(minutes.between(6, 10), late)
        .otherwise(major)
    )
