"""Hashed keys of dimension and fact rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from railmill.functions.labels import KEY_NULL_TOKEN, UNKNOWN_MEMBER


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols: Column | str, null_token: str = KEY_NULL_TOKEN) -> Column:
    """MD5 hex over the fields as text joined by ``-``; nulls become a token.

    Each field is coalesced first because ``concat_ws`` would drop nulls and let
    (a, null) and (null, a) collide.
    """
    parts = [F.coalesce(_col(c).cast("string"), F.lit(null_token)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def unknown_key() -> Column:
    """Key of the Unknown member row of a dimension."""
    return F.md5(F.lit(UNKNOWN_MEMBER))
