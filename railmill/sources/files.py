"""Batch inputs: tagged dumps, seeds, reference extracts, Parquet sets."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railmill.schemas import AREA_FIELDS, AREA_TICKS, SEEDS, STANOX_FIELDS, STOP_COLUMNS


def tagged_records(lines: DataFrame, ingest_ts: Column | dt.datetime) -> DataFrame:
    """One JSON object per line to ``(record_type, payload, ingest_ts)``.

    The first key of the object is the record type and its value the payload, null
    unless that value is an object. Blank and malformed lines are left out. One
    ``ingest_ts`` serves the whole run, so a load past midnight stays in one day.
    """
    stamp = ingest_ts if isinstance(ingest_ts, Column) else F.lit(ingest_ts)
    tagged = lines.select(F.trim("value").alias("value")).filter(F.col("value") != "")
    tagged = tagged.withColumn("record_type", F.get(F.json_object_keys("value"), F.lit(0)))
    held = F.try_element_at(F.from_json("value", "map<string,string>"), F.col("record_type"))
    payload = F.when(F.json_object_keys(held).isNotNull(), held)
    return tagged.filter(F.col("record_type").isNotNull()).select(
        "record_type", payload.alias("payload"), stamp.cast("timestamp").alias("ingest_ts")
    )


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Deals rows out evenly, for input that cannot be split and is costly to parse.

    Without a number of ``partitions`` there are as many as a shuffle has.
    """
    return df.repartition(partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def read_tagged_dump(spark: SparkSession, path: str, ingest_ts: dt.datetime, partitions: int | None = None) -> DataFrame:
    """Tagged NDJSON files. A gzip file is read by one task, so its lines are spread at once."""
    return tagged_records(spread(spark.read.text(path), partitions), ingest_ts)


def read_seed(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Seed CSV with a header, quoted fields and declared types."""
    return spark.read.schema(SEEDS[name]).csv(path, header=True, quote='"', escape='"', mode="FAILFAST")


def read_reference_extract(spark: SparkSession, path: str, array: str, fields: dict[str, str]) -> DataFrame:
    """Reference document holding one array of flat objects under ``array``."""
    element = ", ".join(f"`{name}`: string" for name in fields)
    documents = spark.read.schema(f"`{array}` array<struct<{element}>>").json(path, multiLine=True)
    return flatten_extract(documents, array, fields)


def flatten_extract(documents: DataFrame, array: str, fields: dict[str, str]) -> DataFrame:
    """Nested array of objects to renamed columns, one row per object."""
    items = documents.select(F.explode(F.col(f"`{array}`")).alias("item"))
    return items.select(*[F.col(f"item.`{source}`").alias(name) for source, name in fields.items()])


def normalise_areas(rows: DataFrame, cells: str = "cells") -> DataFrame:
    """Area table rows (an array of cell texts) to named columns with tick marks as booleans.

    Rows with another number of cells than the header are dropped.
    """
    names = list(AREA_FIELDS.values())
    good = rows.filter(F.size(cells) == len(names))
    values = {name: F.get(F.col(cells), F.lit(i)) for i, name in enumerate(names)}
    ticked = {name: F.coalesce(values[name] == "✔", F.lit(False)) for name in AREA_TICKS}
    return good.select(*[{**values, **ticked}[name].alias(name) for name in names])


def normalise_station_areas(rows: DataFrame) -> DataFrame:
    """Station-area table with our names; the code is its first two characters."""
    named = rows.withColumnsRenamed(STANOX_FIELDS)
    return named.withColumn("stanox_code", F.substring("stanox_code", 1, 2))


def project_columns(df: DataFrame, columns=STOP_COLUMNS) -> DataFrame:
    """Only the listed columns; the scan reads no others."""
    return df.select(*columns)


def read_parquet_set(spark: SparkSession, *globs: str) -> DataFrame:
    return spark.read.parquet(*globs)


def named_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
