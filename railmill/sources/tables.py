"""Table writers: append, partition overwrite, merge, clustered files, snapshots."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railmill.functions import surrogate_key
from railmill.functions.labels import DAY_FLAGS, PARQUET_ROWS_PER_FILE
from railmill.operators.aggregates import PAGE_ROWS, ordered_pages
from railmill.operators.joins import upsert
from railmill.session import shared_dir

if TYPE_CHECKING:
    from railmill.sources.key_index import KeyIndex

DAY = "ingest_date"


def with_ingest_date(df: DataFrame, ts: str = "ingest_ts") -> DataFrame:
    """Adds the day the table is partitioned by."""
    return df.withColumn(DAY, F.to_date(ts))


def write_parquet(df: DataFrame, path: str, rows_per_file: int = PARQUET_ROWS_PER_FILE) -> None:
    df.write.option("maxRecordsPerFile", rows_per_file).mode("overwrite").parquet(path)


def split_required(df: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with all required columns, and the rejected rest."""
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required])
    return df.filter(complete), df.filter(~complete)


def append_days(df: DataFrame, path: str, required: list[str], ts: str = "ingest_ts") -> DataFrame:
    """Appends to a day-partitioned table and returns the rows that lacked a required column."""
    good, rejected = split_required(df, required)
    with_ingest_date(good, ts).write.mode("append").partitionBy(DAY).parquet(path)
    return rejected


def overwrite_days(df: DataFrame, path: str, cluster_by: list[str] | None = None, ts: str = "ingest_ts") -> None:
    """Replaces exactly the days present in ``df`` and leaves all other days alone."""
    days = with_ingest_date(df, ts)
    if cluster_by:
        days = clustered(days, [DAY, *cluster_by])
    days.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)


def clustered(df: DataFrame, keys: list[str]) -> DataFrame:
    """Range-partitioned and sorted by the keys, so that file statistics can skip files."""
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def materialise(df: DataFrame, name: str, as_table: bool) -> DataFrame:
    """Registers a model as a view, or stores it as a table of that name."""
    if as_table:
        df.write.mode("overwrite").saveAsTable(name)
    else:
        df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = file_system(spark, path)
    return fs.exists(hadoop_path)


def delete(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = file_system(spark, path)
    fs.delete(hadoop_path, True)


def merge_days(
    spark: SparkSession,
    path: str,
    updates: DataFrame,
    keys: list[str],
    ts: str = "ingest_ts",
    event_ts: str | None = None,
    index: KeyIndex | None = None,
    announce: Callable[[set[dt.date]], None] = lambda days: None,
) -> set[dt.date]:
    """Upserts ``updates`` (one row per key) into a day-partitioned table and returns the days it rewrote.

    Only days that hold a matching key, or receive a row, are rewritten: the cost follows
    the touched days, not the table. ``index`` (key -> day, of this table) tells where matching keys lie, so
    no history is scanned and no event time trusted. Without it, ``event_ts`` may name an event time that is
    part of the key: a row of the same key cannot have arrived before it, so days before the earliest event of the
    updates (less one day for clocks that differ) are not even read; that misses rows whose clock was further ahead.
    The list of days is all that reaches the driver; ``announce`` gets it before anything is written. A rerun with the
    same updates gives the same table, so a lost run is simply repeated. The updates are stored while the merge
    lasts, because several steps read them.
    """
    new = with_ingest_date(updates, ts)
    staged = shared_dir(spark, "merge")
    try:
        new.write.parquet(staged)
        new = spark.read.schema(new.schema).parquet(staged)
        new_days = {row[0] for row in new.select(DAY).distinct().collect()}
        entries = new.select(key_text(keys).alias("key"), F.col(DAY).alias("day"))
        known = path_exists(spark, path)
        if index is not None:
            old_days = index.days(entries)
            index.add(entries)  # before the rows: an entry too many does no harm
        elif known:
            table = spark.read.schema(new.schema).parquet(path)
            hit = matching_days(table, new, keys, None if event_ts is None else earliest_day(new, event_ts))
            old_days = {row[0] for row in hit.distinct().collect()}
        announce((old_days if known else set()) | new_days)
        if not known:
            new.write.mode("overwrite").partitionBy(DAY).parquet(path)
            return new_days
        table = spark.read.schema(new.schema).parquet(path)
        touched = sorted(old_days | new_days)
        merged = upsert(table.filter(F.col(DAY).isin(touched)), new, keys)
        merged.select(*new.columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            DAY
        ).parquet(path)
        spark.catalog.refreshByPath(path)
        # a day whose rows all moved elsewhere got no new files and must not keep the old ones
        left = sorted(old_days - new_days)
        if left:
            rows = spark.read.schema(new.schema).parquet(path).filter(F.col(DAY).isin(left))
            stay = rows.join(new.select(*keys), keys, "left_anti").select(DAY).distinct()
            for day in set(left) - {row[0] for row in stay.collect()}:
                delete(spark, f"{path}/{DAY}={day.isoformat()}")
            spark.catalog.refreshByPath(path)
        return old_days | new_days
    finally:
        delete(spark, staged)


def key_text(keys: list[str]) -> Column:
    """One text for a key of one or more columns, as a key index holds it."""
    return F.col(keys[0]).cast("string") if len(keys) == 1 else surrogate_key(*keys)


def earliest_day(updates: DataFrame, event_ts: str) -> dt.date | None:
    """The day before the earliest event; None if an event time is missing or there are no rows."""
    event = F.to_date(event_ts)
    found = updates.agg(F.min(event).alias("first"), F.count_if(event.isNull()).alias("missing")).first()
    return None if found["missing"] or found["first"] is None else found["first"] - dt.timedelta(days=1)


def matching_days(table: DataFrame, updates: DataFrame, keys: list[str], since: dt.date | None = None) -> DataFrame:
    """Days of the rows of ``table`` whose key is in ``updates``, from ``since`` on."""
    reached = table if since is None else table.filter(F.col(DAY) >= F.lit(since))
    return reached.join(updates.select(*keys), keys, "left_semi").select(DAY)


def geo_snapshot(geo: DataFrame, key: str = "station_id") -> DataFrame:
    """Keyed lookup rows: ``geo:<key>`` and a JSON value with name and coordinates."""
    value = F.to_json(
        F.struct("location_name", F.col("latitude").alias("lat"), F.col("longitude").alias("lon")),
        {"ignoreNullFields": "false"},
    )
    return geo.select(F.concat(F.lit("geo:"), F.col(key).cast("string")).alias("key"), value.alias("value"))


def schedule_snapshot(schedules: DataFrame, key: str = "train_uid", page_rows: int = PAGE_ROWS) -> DataFrame:
    """Per key the list of its schedules with ISO dates and seven day flags, in pages.

    An ordinary key has the single page 0.
    """
    short = ("mon", "tue", "wed", "thu", "fri", "sat", "sun")
    records = schedules.select(
        key,
        "schedule_id",
        *[c for c in ("train_uid",) if c != key],
        "stp_indicator",
        F.col("schedule_start_date").cast("string").alias("start_date"),
        F.col("schedule_end_date").cast("string").alias("end_date"),
        *[F.coalesce(F.col(flag), F.lit(False)).alias(name) for flag, name in zip(DAY_FLAGS, short)],
    )
    items = [c for c in records.columns if c != key]
    lists = ordered_pages(records, [key], ["start_date", "schedule_id"], items, page_rows)
    value = F.to_json("items", {"ignoreNullFields": "false"})
    return lists.select(
        F.concat(F.lit("schedule:"), F.col(key).cast("string")).alias("key"), "page", value.alias("value")
    )
