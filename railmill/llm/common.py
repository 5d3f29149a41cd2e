"""Small helpers the operators share: table access, scratch tables, hold-out split."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable
from contextvars import ContextVar
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railmill.session import shared_dir
from railmill.sources.tables import delete

WORD = r"[^\x20\x09-\x0D]+"
FOLDS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# folders of steps by application, of the pipeline stage that ran last
_HELD: dict[str, list[str]] = defaultdict(list)
_STAGE: ContextVar[list[str] | None] = ContextVar("stage", default=None)


class Scratch:
    """Tables written once below the folder all executors share, and read back.

    Writing cuts the lineage: a lost executor costs its running tasks, not the steps before.
    """

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark = spark
        self.path = shared_dir(spark, purpose)
        self._n = 0
        if _STAGE.get() is not None:
            _STAGE.get().append(self.path)

    def keep(self, df: DataFrame, name: str = "step") -> DataFrame:
        self._n += 1
        path = f"{self.path}/{self._n:03d}-{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def stage(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A pipeline stage: its steps are deleted when the next stage starts, for its result has been written by then."""

    @wraps(fn)
    def staged(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        held = _HELD[spark.sparkContext.applicationId]
        while held:
            delete(spark, held.pop())
        token = _STAGE.set(held)
        try:
            return fn(spark, docs, sf_dir)
        finally:
            _STAGE.reset(token)

    return staged


def unused(columns: list[str], name: str) -> str:
    """A column name that clashes with none of ``columns``, upper or lower case."""
    taken = {c.lower() for c in columns}
    name = f"_{name}"
    while name in taken:
        name = f"_{name}"
    return name


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves remainder 0; a null id is never held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def is_held_out(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % FOLDS == 0


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
