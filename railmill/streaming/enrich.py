"""Typed movements to the live topic, with lookups refreshed per micro-batch."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from railmill.plans.incremental import last_run
from railmill.plans.live import enrich_movements
from railmill.streaming import sinks

LOOKUPS = ("live_places", "live_schedules", "dim_toc")
Lookups = Callable[[], tuple[DataFrame, DataFrame, DataFrame]]


def stored_lookups(spark: SparkSession, paths: dict[str, str]) -> Lookups:
    """Places, signalling ids and operators as the daily run last stored them."""

    def lookups() -> tuple[DataFrame, DataFrame, DataFrame]:
        return tuple(spark.read.parquet(paths[name]) for name in LOOKUPS)

    return lookups


class VersionedLookups:
    """The lookups of the last finished daily run, held in memory until a newer run has finished.

    Each call reads the log of runs, a small file; the tables are read again only if it names a new version. What a lost
    executor held of them is read again from that version, which the next run but one deletes at the earliest.
    """

    def __init__(self, spark: SparkSession, warehouse: str):
        self.spark, self.warehouse = spark, warehouse
        self.version: str | None = None
        self.held: tuple[DataFrame, DataFrame, DataFrame] | tuple[()] = ()

    def __call__(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        run = last_run(self.spark, self.warehouse)
        if run is None:
            raise FileNotFoundError(f"no daily run has finished in {self.warehouse}")
        if run["version"] != self.version:
            before = self.held
            self.held = tuple(self.spark.read.parquet(run["paths"][name]).persist() for name in LOOKUPS)
            self.version = run["version"]
            for lookup in before:
                lookup.unpersist()
        return self.held


def enrich_stream(
    movements: DataFrame, lookups: Lookups, day: Callable[[], dt.date] | None, out: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Enriches every micro-batch with geo, schedules and operators.

    ``lookups`` is called per micro-batch, so the daily refresh is seen without a restart; ``VersionedLookups``
    reads the tables anew only then. ``day`` gives the date schedules must be valid on; None says that
    the lookups hold one schedule per signalling id already, as ``stored_lookups`` reads them.
    """

    def handle(batch: DataFrame, number: int) -> None:
        geo, schedules, operators = lookups()
        sinks.write_batch(enrich_movements(batch, geo, schedules, operators, day() if day else None), number, out)

    return sinks.start(movements, handle, checkpoint, **trigger)
