"""Live state per train: newest fields, bounded trail, expiry after silence.

A train's state is its newest record and its last points by arrival position, so the
result does not depend on how the rows were cut into micro-batches or Arrow batches. At
most ``points`` rows are ever held per train, however busy it is.
"""

from __future__ import annotations

import datetime as dt
import heapq
import json
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from railmill.functions.labels import LIVE_STALE_MINUTES, LIVE_TRAIL_POINTS
from railmill.operators.dedup import first_k, remaining_order
from railmill.operators.filters import not_stale
from railmill.schemas import TRAIL_POINT
from railmill.streaming import sinks
from railmill.streaming.table_log import HOUR, LoggedTable, hour_of

# Python workers get the processor itself; they need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STREAM_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}
NO_DATA = "spark.sql.streaming.noDataMicroBatches.enabled"
TIME_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
FIELDS = [
    "train_uid", "toc_name", "latitude", "longitude", "location_name", "next_station", "planned_event_type",
    "planned_timestamp", "timetable_variation", "variation_status", "event_type",
]
OUTPUT = f"""
    train_id string, train_uid string, toc_name string, latitude double, longitude double, location_name string,
    next_station string, planned_event_type string, planned_timestamp string, timetable_variation bigint,
    variation_status string, event_type string, trail string, last_update string, expired boolean
"""
BATCH = "batch_id"


class Held:
    """One state value of a train; it travels with the train's rows, so reading and changing it asks nobody."""

    def __init__(self, state: GroupState):
        self.held = state

    def get(self) -> tuple | None:
        return self.held.getOption

    def update(self, value: tuple) -> None:
        self.held.update(value)

    def clear(self) -> None:
        self.held.remove()


class LiveTrain:
    """Keeps, per train, the last records in arrival order as a JSON list in one state value."""

    def __init__(self, points: int, expiry_ms: int | None, fields: list[str]):
        self.points = points
        self.expiry_ms = expiry_ms
        self.fields = fields

    def __call__(self, key, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        self.state = Held(state)
        return iter(list(self.handleExpiry(key) if state.hasTimedOut else self.handleInputRows(key, rows, state)))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer: GroupState | None) -> Iterator[pd.DataFrame]:
        held = self.state.get()
        kept = [] if held is None else json.loads(held[0])
        for batch in rows:
            # plain lists of the few newest rows: frame operations cost more than all else for a train
            last = batch["arrival"].to_numpy().argsort()[-self.points :]
            arrivals, times, *values = (
                [None if v is None or v != v else v for v in batch[c].to_numpy()[last].tolist()]
                for c in ("arrival", "arrived_at", *self.fields)
            )
            added = [[int(a), list(v), at] for a, at, *v in zip(arrivals, times, *values)]
            kept = heapq.nlargest(self.points, kept + added, key=lambda record: record[0])
        kept.sort(key=lambda record: record[0])
        self.state.update((json.dumps(kept, default=str),))
        if self.expiry_ms is not None:
            timer.setTimeoutDuration(self.expiry_ms)
        row = {"train_id": key[0], **dict(zip(self.fields, kept[-1][1]))}
        lon, lat = self.fields.index("longitude"), self.fields.index("latitude")
        row["trail"] = json.dumps([{"longitude": v[lon], "latitude": v[lat]} for _, v, _ in kept])
        row["last_update"] = max((at for *_, at in kept if at is not None), default=None)
        yield pd.DataFrame([row | {"expired": False}])

    def handleExpiry(self, key) -> Iterator[pd.DataFrame]:
        """The train was silent for too long: its state goes, and a last row says so."""
        held = self.state.get()
        kept = [] if held is None else json.loads(held[0])
        self.state.clear()
        newest = max((at for *_, at in kept if at is not None), default=None)
        if newest is not None:
            silent = dt.datetime.strptime(newest, "%Y-%m-%d %H:%M:%S.%f") + dt.timedelta(milliseconds=self.expiry_ms)
            newest = silent.strftime("%Y-%m-%d %H:%M:%S.%f")
        row = {"train_id": key[0], **dict.fromkeys(self.fields), "trail": None, "last_update": newest, "expired": True}
        yield pd.DataFrame([row]).astype(object)


def live_updates(
    enriched: DataFrame, points: int = LIVE_TRAIL_POINTS, stale_minutes: float | None = LIVE_STALE_MINUTES
) -> DataFrame:
    """Streaming states of the trains each micro-batch touched.

    ``enriched`` carries an ``arrival`` position and the time it arrived, ``ingest_ts``. Positions
    must compare across the rows of a train: a log offset does if the log is keyed by train, which
    puts a train into one partition; else use a message number. ``last_update`` is the newest arrival
    time of the records held, so a replayed micro-batch gives the same state. Rows without a train
    id or coordinates are ignored. A train that is silent for ``stale_minutes`` of processing time loses its state, trail
    included, and a row with ``expired`` set says so, dated so long after its last update; None keeps states for ever.
    """
    located = enriched.filter(
        (F.col("train_id") != "") & F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    ).withColumnRenamed("next_location", "next_station")
    slim = located.select(
        "train_id",
        F.col("arrival").cast("bigint").alias("arrival"),
        F.date_format(F.col("ingest_ts").cast("timestamp"), TIME_TEXT).alias("arrived_at"),
        *[F.col(c).cast("string").alias(c) if c == "planned_timestamp" else F.col(c) for c in FIELDS],
    )
    expiry = None if stale_minutes is None else int(stale_minutes * 60_000)
    states = slim.groupBy("train_id").applyInPandasWithState(
        LiveTrain(points, expiry, FIELDS).__call__,
        outputStructType=OUTPUT,
        stateStructType="records string",
        outputMode="update",
        timeoutConf=GroupStateTimeout.NoTimeout if expiry is None else GroupStateTimeout.ProcessingTimeTimeout,
    )
    return states.withColumns(
        {
            "planned_timestamp": F.to_timestamp("planned_timestamp"),
            "last_update": F.to_timestamp("last_update", TIME_TEXT),
            "trail": F.from_json("trail", f"array<{TRAIL_POINT}>"),
        }
    )


def live_state_stream(
    enriched: DataFrame, out: str, checkpoint: str, stale_minutes: float | None = LIVE_STALE_MINUTES, **trigger
) -> StreamingQuery:
    """Writes the states of every micro-batch by the hour of their update, each with the number of its batch.

    A query takes its settings when it starts, so the session gets its own back afterwards.
    """
    conf = enriched.sparkSession.conf
    # timers need micro-batches without rows; an available-now run would keep adding them
    settings = STREAM_SETTINGS | {NO_DATA: "false" if trigger.get("available_now") else "true"}
    before = {key: conf.get(key, None) for key in settings}
    for key, value in settings.items():
        conf.set(key, value)
    try:
        table = LoggedTable(enriched.sparkSession, out)

        def handle(batch: DataFrame, number: int) -> None:
            numbered = batch.withColumns({BATCH: F.lit(number).cast("bigint"), HOUR: hour_of("last_update")})
            table.write(numbered, number, checkpoint)

        return sinks.start(
            live_updates(enriched, stale_minutes=stale_minutes), handle, checkpoint, output_mode="update", **trigger
        )
    finally:
        for key, value in before.items():
            conf.unset(key) if value is None else conf.set(key, value)


def read_live_states(
    spark: SparkSession, out: str, as_of: dt.datetime | None = None, stale_minutes: int = LIVE_STALE_MINUTES
) -> DataFrame:
    """The newest state per train that has not expired; with ``as_of`` as it was at that moment.

    A train silent for ``stale_minutes`` before ``as_of`` is left out, whether its expiry was written by then or not.

    With ``as_of`` only the hours are listed and read in which such a state can have been written: a state is the newest
    of those updated up to that moment, whatever came later.
    """
    table = LoggedTable(spark, out)
    if as_of is None:
        written = table.read()
    else:
        first, last = ((as_of - dt.timedelta(minutes=m)).strftime("%Y-%m-%d-%H") for m in (stale_minutes, 0))
        written = not_stale(table.read(lambda values: first <= values[-1] <= last), as_of, minutes=stale_minutes)
        written = written.filter(F.col("last_update") <= F.lit(as_of))
    written = written.drop(HOUR)
    order = [F.col(BATCH).desc(), *remaining_order(written, {"train_id", BATCH, "trail"})]
    newest = first_k(written, ["train_id"], order, 1)
    return newest.filter(~F.coalesce("expired", F.lit(False))).drop(BATCH, "expired")
