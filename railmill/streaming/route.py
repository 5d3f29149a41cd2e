"""Raw messages to typed topics, dead letters and raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from railmill.functions.labels import TOPICS
from railmill.schemas import MESSAGE_TYPES
from railmill.sources.feeds import parse_messages, route_messages, split_frames, typed_events
from railmill.streaming import sinks
from railmill.streaming.table_log import HOUR, LoggedTable, hour_of

TOPIC_PARTS = ["topic", HOUR]


def routed(frames: DataFrame) -> DataFrame:
    """Frames ``(value, ingest_ts)`` to ``(topic, value)``; one parse per message."""
    return route_messages(parse_messages(split_frames(frames)))


def route_stream(frames: DataFrame, out: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Writes every topic, dead letters included, in one pass per micro-batch, by topic and hour of arrival."""
    table = LoggedTable(frames.sparkSession, out, TOPIC_PARTS)
    messages = parse_messages(split_frames(frames))
    dated = route_messages(messages.withColumn(HOUR, hour_of("ingest_ts")), keep=[HOUR])
    return sinks.start(dated, lambda batch, n: table.write(batch, n, checkpoint), checkpoint, **trigger)


def read_routed(spark: SparkSession, out: str) -> DataFrame:
    """``(topic, value)`` of all that the routing job has committed."""
    return LoggedTable(spark, out, TOPIC_PARTS).read().select("topic", "value")


def read_topic_files(spark: SparkSession, out: str, topic: str) -> DataFrame:
    """What the routing job wrote for one topic so far."""
    return LoggedTable(spark, out, TOPIC_PARTS).read(lambda values: values[0] == topic).select("value")


def table_stream(frames: DataFrame, out: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Appends every typed event to the raw table of its topic, by hour of arrival.

    The parsed batch is stored while its tables are written; if an executor is lost Spark
    parses the lost part again. Each table logs its own batches, so a replay goes on where the first attempt ended.
    """
    tables = {code: LoggedTable(frames.sparkSession, f"{out}/{TOPICS[code]}") for code in MESSAGE_TYPES}

    def handle(batch: DataFrame, number: int) -> None:
        messages = parse_messages(split_frames(batch)).persist()
        try:
            for code, event in MESSAGE_TYPES.items():
                rows = typed_events(messages, event)
                tables[code].write(rows.withColumn(HOUR, hour_of("ingest_ts")), number, checkpoint)
        finally:
            messages.unpersist()

    return sinks.start(frames, handle, checkpoint, **trigger)


def read_table(spark: SparkSession, out: str, topic: str) -> DataFrame:
    """The raw table of one topic."""
    return LoggedTable(spark, f"{out}/{topic}").read().drop(HOUR)


def compact(spark: SparkSession, out: str, before: str) -> int:
    """Compacts the hours before ``before`` of a routing job's output or of all raw tables below ``out``."""
    routed_table = LoggedTable(spark, out, TOPIC_PARTS)
    if routed_table.exists():
        return routed_table.compact(before)
    tables = [LoggedTable(spark, f"{out}/{topic}") for topic in TOPICS.values()]
    return sum(t.compact(before) for t in tables if t.exists())
