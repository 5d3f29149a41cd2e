"""Staging models: typed, deduplicated, keyed rows of every input.

``run_date`` limits a model to the partition of that day (``lookback_days`` adds the days
before it for late rows that are merged); without it the whole input is read. Nothing
reads the clock.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railmill.functions import blank_to_null, iso_to_date, safe_cast, strict_cast, surrogate_key
from railmill.operators.arrays import computed_once
from railmill.operators.dedup import keep_any, keep_latest
from railmill.operators.filters import record_type
from railmill.schemas import ASSOCIATION_PAYLOAD, SCHEDULE_PAYLOAD, TIPLOC_PAYLOAD

ACTIVATION_DEDUP = [
    "train_id", "train_uid", "schedule_start_date", "schedule_type", "tp_origin_timestamp",
    "origin_dep_timestamp", "creation_timestamp",
]
ACTIVATION_TIMES = ("tp_origin_timestamp", "origin_dep_timestamp", "creation_timestamp", "msg_queue_timestamp")
MOVEMENT_DEDUP = ["train_id", "loc_stanox", "actual_timestamp"]
MOVEMENT_KEY = ["train_id", "toc_id", "next_report_stanox", "loc_stanox", "actual_timestamp"]
MOVEMENT_NUMBERS = (
    "toc_id", "loc_stanox", "next_report_stanox", "reporting_stanox", "timetable_variation", "next_report_run_time",
)
MOVEMENT_FLAGS = ("correction_ind", "offroute_ind", "train_terminated", "delay_monitoring_point", "auto_expected")
MOVEMENT_COLUMNS = [
    "train_id", "division_code", "toc_id", "route", "loc_stanox", "next_report_stanox", "reporting_stanox",
    "platform", "actual_timestamp", "planned_timestamp", "planned_event_type", "event_type",
    "timetable_variation", "variation_status", "next_report_run_time", "correction_ind", "offroute_ind",
    "train_terminated", "delay_monitoring_point", "auto_expected", "event_source", "msg_type", "ingest_ts",
]


def _of_days(df: DataFrame, run_date: dt.date | None, lookback_days: int = 0) -> DataFrame:
    """Rows that arrived on the run day or up to ``lookback_days`` before it."""
    if run_date is None:
        return df
    first = run_date - dt.timedelta(days=lookback_days)
    if "ingest_date" in df.columns:
        return df.filter(F.col("ingest_date").between(F.lit(first), F.lit(run_date)))
    start = dt.datetime.combine(first, dt.time())
    end = dt.datetime.combine(run_date, dt.time()) + dt.timedelta(days=1)
    return df.filter((F.col("ingest_ts") >= F.lit(start)) & (F.col("ingest_ts") < F.lit(end)))


def activation(raw: DataFrame, run_date: dt.date | None = None, lookback_days: int = 0) -> DataFrame:
    rows = keep_any(_of_days(raw, run_date, lookback_days), ACTIVATION_DEDUP)
    typed = {
        "schedule_start_date": strict_cast(F.col("schedule_start_date"), "date"),
        "schedule_end_date": strict_cast(F.col("schedule_end_date"), "date"),
        **{c: strict_cast(F.col(c), "timestamp") for c in ACTIVATION_TIMES},
    }
    keyed = rows.withColumn("activation_id", surrogate_key(*ACTIVATION_DEDUP))
    others = [c for c in raw.columns if c not in ("ingest_ts", "ingest_date")]
    return keyed.withColumns(typed).select("activation_id", "ingest_ts", *others)


def movement(
    raw: DataFrame, run_date: dt.date | None = None, dedup_keys: list[str] | None = None, lookback_days: int = 0
) -> DataFrame:
    """Movements, one per train, place and instant.

    The event type is not part of that key, so an arrival and a departure at the same
    instant fold into one; ``dedup_keys`` may name a finer key.
    """
    rows = keep_any(_of_days(raw, run_date, lookback_days), dedup_keys or MOVEMENT_DEDUP)
    typed = {
        **{c: safe_cast(F.col(c), "bigint") for c in MOVEMENT_NUMBERS},
        **{c: safe_cast(F.col(c), "boolean") for c in MOVEMENT_FLAGS},
        **{c: strict_cast(F.col(c), "timestamp") for c in ("actual_timestamp", "planned_timestamp", "ingest_ts")},
    }
    keyed = rows.withColumn("movement_id", surrogate_key(*MOVEMENT_KEY))
    return keyed.withColumns(typed).select("movement_id", *MOVEMENT_COLUMNS)


def describer(raw: DataFrame, run_date: dt.date | None = None) -> DataFrame:
    """Berth steps, one per area, instant, berths and description."""
    identity = ["area_id", "event_ts", *[F.coalesce(F.col(c), F.lit("")) for c in ("from_berth", "to_berth", "descr")]]
    rows = keep_any(_of_days(raw, run_date), identity)
    return rows.select(
        surrogate_key(*identity).alias("describer_id"),
        "msg_type",
        "area_id",
        F.col("event_ts").cast("timestamp").alias("event_ts"),
        F.col("ingest_ts").cast("timestamp").alias("ingest_ts"),
        "from_berth",
        "to_berth",
        blank_to_null(F.col("descr")).alias("train_signalling_id"),
        F.col("report_time").cast("string").alias("report_time"),
    )


def _payload(raw: DataFrame, kind: str, schema: str, run_date: dt.date | None) -> DataFrame:
    rows = record_type(_of_days(raw, run_date), kind)
    parsed = computed_once(rows.select("ingest_ts", "payload"), "p", F.from_json("payload", schema))
    return parsed.select("ingest_ts", "p.*")


def schedule(raw: DataFrame, run_date: dt.date | None = None) -> DataFrame:
    """Schedules, the newest per uid, validity and planning indicator."""
    keys = ["CIF_train_uid", "schedule_start_date", "schedule_end_date", "CIF_stp_indicator"]
    rows = keep_latest(_payload(raw, "JsonScheduleV1", SCHEDULE_PAYLOAD, run_date), keys)
    return rows.select(
        surrogate_key(*keys, "ingest_ts").alias("schedule_id"),
        "ingest_ts",
        F.col("CIF_train_uid").alias("train_uid"),
        "transaction_type",
        strict_cast(F.col("schedule_start_date"), "date").alias("schedule_start_date"),
        strict_cast(F.col("schedule_end_date"), "date").alias("schedule_end_date"),
        "schedule_days_runs",
        F.col("CIF_bank_holiday_running").alias("bank_holiday_code"),
        "train_status",
        F.col("CIF_stp_indicator").alias("stp_indicator"),
        "atoc_code",
        "applicable_timetable",
        F.col("schedule_segment").alias("schedule_segment_json"),
        F.get_json_object("schedule_segment", "$.schedule_location").alias("schedule_location_json"),
    )


def association(raw: DataFrame, run_date: dt.date | None = None) -> DataFrame:
    """Associations, the newest per pair, validity, category, place and indicator."""
    keys = [
        "main_train_uid", "assoc_train_uid", "assoc_start_date", "assoc_end_date", "category", "location",
        "CIF_stp_indicator",
    ]
    identity = [
        "main_train_uid", "assoc_train_uid", "assoc_start_date", "assoc_end_date", "location", "category",
        "CIF_stp_indicator",
    ]
    rows = keep_latest(_payload(raw, "JsonAssociationV1", ASSOCIATION_PAYLOAD, run_date), keys)
    return rows.select(
        "ingest_ts",
        surrogate_key(*identity).alias("association_id"),
        "transaction_type",
        "main_train_uid",
        "assoc_train_uid",
        iso_to_date(F.col("assoc_start_date")).alias("assoc_start_date"),
        iso_to_date(F.col("assoc_end_date")).alias("assoc_end_date"),
        "assoc_days",
        F.col("category").alias("assoc_category"),
        "date_indicator",
        F.col("location").alias("assoc_location"),
        "base_location_suffix",
        "assoc_location_suffix",
        "diagram_type",
        F.col("CIF_stp_indicator").alias("stp_indicator"),
    )


def tiploc(raw: DataFrame) -> DataFrame:
    """Timing points, the newest per code, over the whole dump history."""
    rows = keep_latest(_payload(raw, "TiplocV1", TIPLOC_PAYLOAD, None), ["tiploc_code"])
    return rows.select(
        "ingest_ts",
        "transaction_type",
        "tiploc_code",
        strict_cast(F.col("nalco"), "bigint").alias("nalco"),
        strict_cast(F.col("stanox"), "bigint").alias("stanox"),
        "crs_code",
        "description",
        "tps_description",
    )
