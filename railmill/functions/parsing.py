"""Lenient and strict parsing of raw text fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from railmill.functions.labels import DAY_FLAGS

# milliseconds of 0001-01-01 and 9999-12-31T23:59:59.999: the range of a timestamp
MIN_MILLIS = -62_135_596_800_000
MAX_MILLIS = 253_402_300_799_999


def parse_millis(col: Column) -> Column:
    """Epoch milliseconds (text) to timestamp; null for anything unusable."""
    millis = col.try_cast("bigint")
    return F.when(millis.between(MIN_MILLIS, MAX_MILLIS), F.timestamp_millis(millis))


def parse_int(col: Column, default: int | None = None) -> Column:
    number = col.try_cast("bigint")
    return number if default is None else F.coalesce(number, F.lit(default).cast("bigint"))


def parse_bool(col: Column) -> Column:
    """True only for the word "true" in any case; everything else, null too, is false."""
    return F.coalesce(F.lower(col.cast("string")) == "true", F.lit(False))


def date_midnight(col: Column) -> Column:
    """Date text to the timestamp of its midnight; null for missing or bad dates."""
    return F.try_to_timestamp(F.concat(col, F.lit("T00:00:00Z")))


def safe_cast(col: Column, type_name: str) -> Column:
    return col.try_cast(type_name)


def strict_cast(col: Column, type_name: str) -> Column:
    """A cast that fails the job on bad input (ANSI mode)."""
    return col.cast(type_name)


def iso_to_date(col: Column) -> Column:
    """ISO timestamp text to its date."""
    return F.to_date(F.to_timestamp(col))


def blank_to_null(col: Column) -> Column:
    return F.nullif(F.trim(col), F.lit(""))


def json_text(col: Column, path: str) -> Column:
    """Scalar as text, or subtree as JSON text, at a path such as ``$.a.b``."""
    return F.get_json_object(col, path)


def sector_code_number(col: Column) -> Column:
    """Operating code of an operator; the sentinel ``?`` stands for 100."""
    return F.when(col == "?", F.lit(100)).otherwise(col.cast("int"))


def day_flags(mask: Column) -> list[Column]:
    """Seven booleans, Monday first, from a mask such as ``1111100``."""
    return [(F.substring(mask, i + 1, 1) == "1").alias(name) for i, name in enumerate(DAY_FLAGS)]
