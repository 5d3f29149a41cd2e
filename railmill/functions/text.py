"""Text normalisation and codes cut out of text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from railmill.functions.labels import CATEGORY_COLOURS, DEFAULT_COLOUR
from railmill.functions.parsing import blank_to_null


def code_normalise(col: Column) -> Column:
    """Trimmed upper-case code; blank becomes null."""
    return F.upper(blank_to_null(col))


def slug_code(name: Column, prefix: str = "ZZ_") -> Column:
    """Prefix plus lower-case name with every run of other characters as ``_``."""
    return F.concat(F.lit(prefix), F.regexp_replace(F.lower(name), "[^a-z0-9]+", "_"))


def signalling_id(train_id: Column) -> Column:
    """Characters 3 to 6 of a train id of at least six characters."""
    return F.when(F.length(train_id) >= 6, F.substring(train_id, 3, 4))


def text_from(col: Column, start: int) -> Column:
    return F.substring(col, start, 2**31 - 1)


def area_of_station(station_id: Column, padded: bool = False) -> Column:
    """First two digits of a station number.

    Station numbers are five digits but arrive as integers, so leading zeros are
    gone (1234 gives 12). ``padded`` restores them first (01234 gives 1).
    """
    text = station_id.cast("string")
    return F.left(F.lpad(text, 5, "0") if padded else text, F.lit(2)).cast("int")


def concat_or_null(*cols: Column) -> Column:
    """Concatenation that is null as soon as one part is."""
    return F.concat(*[c.cast("string") for c in cols])


def category_colour(category: Column) -> Column:
    """Display colour of the first known fragment the category name contains."""

    def rgb(colour: tuple[int, int, int]) -> Column:
        return F.array(*[F.lit(x) for x in colour])

    name = F.lower(category)
    fragments = list(CATEGORY_COLOURS.items())
    start = F.when(name.contains(fragments[0][0].lower()), rgb(fragments[0][1]))
    chain = reduce(lambda c, kv: c.when(name.contains(kv[0].lower()), rgb(kv[1])), fragments[1:], start)
    return chain.otherwise(rgb(DEFAULT_COLOUR))
