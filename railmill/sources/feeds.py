"""Message feeds: split frames, type records, route them, divert the bad ones.

All of it is null-on-error column work, so the same functions serve a batch frame and a
stream, and one bad message never stops the others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railmill.functions import parsing
from railmill.functions.labels import DEAD_LETTER_TOPIC, TOPICS
from railmill.operators.arrays import computed_once
from railmill.schemas import (
    BOOLEAN,
    DAY,
    HEADER_FIELDS,
    INTEGER,
    MESSAGE,
    MESSAGE_TYPES,
    MILLIS,
    TEXT,
    TYPED_EVENTS,
)

PARSERS = {
    TEXT: lambda c: c,
    INTEGER: parsing.parse_int,
    MILLIS: parsing.parse_millis,
    BOOLEAN: parsing.parse_bool,
    DAY: parsing.date_midnight,
}


def read_topic(spark: SparkSession, topics: str, options: dict[str, str], earliest: bool = True) -> DataFrame:
    """Message-log topics as a stream of ``value`` and ``timestamp``.

    Needs the Kafka connector on the classpath. Every streaming job here takes any frame
    with these columns instead, such as a file stream.
    """
    reader = spark.readStream.format("kafka").option("subscribe", topics)
    raw = reader.option("startingOffsets", "earliest" if earliest else "latest").options(**options).load()
    return raw.select(F.col("value").cast("string").alias("value"), "timestamp", "topic", "partition", "offset")


def split_frames(frames: DataFrame, body: str = "value") -> DataFrame:
    """One row per record: a frame holds one JSON object or a list; empty frames vanish."""
    blanks = F.lit(" \t\r\n")
    listed = F.when(F.ltrim(body, blanks).startswith("["), F.from_json(body, "array<string>"))
    records = F.coalesce(listed, F.array(F.col(body)))
    others = [F.col(c) for c in frames.columns if c != body]
    return frames.filter(F.trim(body, blanks) != "").select(*others, F.explode(records).alias(body))


def split_berth_frames(frames: DataFrame, body: str = "value") -> DataFrame:
    """Berth records: the entries whose key starts with ``C``, unwrapped."""
    records = split_frames(frames, body)
    others = [F.col(c) for c in records.columns if c != body]
    entries = records.select(*others, F.explode(F.from_json(body, "map<string,string>")).alias("tag", body))
    return entries.filter(F.col("tag").startswith("C")).drop("tag")


def typed_berth_steps(records: DataFrame, body: str = "value", ingest_ts: str = "ingest_ts") -> DataFrame:
    """Berth records to typed columns."""
    fields = F.from_json(body, "map<string,string>")

    def field(name: str) -> Column:
        return F.try_element_at(F.col("_m"), F.lit(name))

    return computed_once(records, "_m", fields).select(
        field("msg_type").alias("msg_type"),
        field("area_id").alias("area_id"),
        parsing.parse_millis(field("time")).alias("event_ts"),
        field("from").alias("from_berth"),
        field("to").alias("to_berth"),
        field("descr").alias("descr"),
        field("report_time").alias("report_time"),
        F.col(ingest_ts).cast("timestamp").alias("ingest_ts"),
    )


def parse_messages(records: DataFrame, body: str = "value") -> DataFrame:
    """Adds ``message`` (header, body), ``msg_type``, ``topic`` and ``reason``.

    ``reason`` is null for a record that has a route; otherwise it says why not.
    """
    parsed = F.from_json(body, f"{MESSAGE}, bad string", {"columnNameOfCorruptRecord": "bad"})
    message = computed_once(records, "message", parsed)
    typed = message.withColumn("msg_type", F.col("message.header.msg_type"))
    routes = F.create_map(*[F.lit(x) for pair in TOPICS.items() for x in pair])
    undecodable = F.col("message").isNull() | F.col("message.bad").isNotNull()
    reason = F.when(undecodable, F.lit("JSONDecodeError")).when(
        F.col("_route").isNull(), F.concat(F.lit("unknown msg_type="), F.coalesce("msg_type", F.lit("None")))
    )
    routed = typed.withColumn("_route", F.try_element_at(routes, F.col("msg_type")))
    return (
        routed.withColumn("reason", reason)
        .withColumn("topic", F.when(F.col("reason").isNull(), F.col("_route")).otherwise(DEAD_LETTER_TOPIC))
        .drop("_route")
    )


def typed_fields(event: str) -> dict[str, Column]:
    """The typed columns of one event type by name, read from the ``message`` struct."""
    fields = {}
    for name, kind in TYPED_EVENTS[event].items():
        part = "header" if name in HEADER_FIELDS else "body"
        fields[name] = PARSERS[kind](F.col(f"message.{part}.{name}"))
    return fields


def typed_columns(event: str) -> list[Column]:
    return [F.col("msg_type"), *[column.alias(name) for name, column in typed_fields(event).items()]]


def typed_together(messages: DataFrame, rows: dict[str, Column]) -> DataFrame:
    """Routed messages of several types as rows of one table: the struct that ``rows`` names for their type.

    All types are taken from one pass over the messages, which a union of ``typed_events`` would read once for each.
    """
    codes = {code: event for code, event in MESSAGE_TYPES.items() if event in rows}
    row = F.lit(None)
    for code, event in codes.items():
        row = F.when(F.col("msg_type") == code, rows[event]).otherwise(row)
    mine = messages.filter(F.col("reason").isNull() & F.col("msg_type").isin(list(codes)))
    return mine.select(F.inline(F.array(row)))


def typed_events(messages: DataFrame, event: str, ingest_ts: str = "ingest_ts") -> DataFrame:
    """Routed messages of one type as flat typed rows."""
    codes = [code for code, name in MESSAGE_TYPES.items() if name == event]
    mine = messages.filter(F.col("reason").isNull() & F.col("msg_type").isin(codes))
    return mine.select(*typed_columns(event), F.col(ingest_ts).cast("timestamp").alias("ingest_ts"))


def typed_json(event: str, ingest_ts: str = "ingest_ts") -> Column:
    """The typed row of one event type as JSON text, nulls kept."""
    row = F.struct(*typed_columns(event), F.col(ingest_ts).alias("ingest_ts"))
    return F.to_json(row, {"ignoreNullFields": "false"})


def dead_letter_json(body: str = "value") -> Column:
    """Reason and raw message; the raw part stays an object where it could be decoded."""
    raw = F.col(body)
    kept = F.to_json(F.struct("reason", F.try_parse_json(raw).alias("raw")))
    as_text = F.to_json(F.struct("reason", raw.alias("raw")))
    return F.when(F.col("reason") == "JSONDecodeError", as_text).otherwise(kept)


def route_messages(
    messages: DataFrame, body: str = "value", ingest_ts: str = "ingest_ts", keep: Sequence[str] = ()
) -> DataFrame:
    """One ``(topic, value)`` row per message: typed JSON, or a dead letter with its reason; ``keep`` names more columns."""
    value = F.when(F.col("reason").isNotNull(), dead_letter_json(body))
    for code, event in MESSAGE_TYPES.items():
        value = value.when(F.col("msg_type") == code, typed_json(event, ingest_ts))
    return messages.select("topic", value.alias("value"), *keep)
