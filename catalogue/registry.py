"""Registry of queries and their SQL twins, and the frame handed to both."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogue import roles
from railmill.session import apply_defaults

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """The test tables by name, and the rail-shaped tables derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = apply_defaults(spark)
        self.sf_dir = sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in roles.BASE_TABLES:
            raise AttributeError(name)
        frame = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        setattr(self, name, frame)
        return frame

    def role(self, name: str) -> DataFrame:
        """A derived table, by the same SQL text the twin uses."""
        sql = roles.ROLES[name]
        used = {t: getattr(self, t) for t in roles.BASE_TABLES if f"{{{t}}}" in sql}
        return self.spark.sql(sql, **used)

    @cached_property
    def models(self):
        from catalogue.models import Models

        return Models(self)


def as_text(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text and nested values as JSON: one rendering in both engines."""
    columns = []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            col = col.cast("string")
        elif isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType)):
            col = F.to_json(col, {"ignoreNullFields": "false"})
        columns.append(col.alias(field.name))
    return df.select(*columns)


def query(name: str, sql: str | None = None, uses: tuple[str, ...] = ()):
    """Registers ``fn(tables) -> DataFrame``; ``uses`` names derived tables the SQL reads."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: as_text(fn(Tables(spark, sf_dir)))
        if sql is not None:
            ORACLE[name] = roles.with_tables(sql, uses)
        return fn

    return register
