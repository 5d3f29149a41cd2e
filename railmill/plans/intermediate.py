"""Intermediate models: labelled schedule headers, stops, operators and places."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railmill.functions import (
    allowance_minutes,
    blank_to_null,
    code_label,
    code_normalise,
    day_flags,
    hhmm_time,
    labels,
    safe_cast,
    slug_code,
    strict_cast,
)
from railmill.operators.arrays import computed_once, json_array_rows
from railmill.operators.filters import latest_partition
from railmill.schemas import SCHEDULE_LOCATION, SCHEDULE_SEGMENT
from railmill.sources.tables import DAY


def _places(df: DataFrame, station: str, tiploc: str, nlc: str, crs: str, name: str) -> DataFrame:
    return df.select(
        F.col(station).alias("station_id"),
        code_normalise(F.col(tiploc)).alias("tiploc_code"),
        F.col(nlc).alias("nlc_code"),
        code_normalise(F.col(crs)).alias("crs_code"),
        code_normalise(F.col(name)).alias("location_name"),
    )


def scheduled_places(tiplocs: DataFrame) -> DataFrame:
    """Places as the timetable names them."""
    return _places(tiplocs, "stanox", "tiploc_code", "nalco", "crs_code", "description")


def reference_places(corpus: DataFrame) -> DataFrame:
    """Places as the running-message reference names them."""
    return _places(corpus, "stanox", "tiploc", "nlc", "three_alpha", "nlc_desc")


def _newest_day(schedules: DataFrame) -> DataFrame:
    """The newest load; where the partition column is at hand, only its files are read."""
    day = F.col(DAY) if DAY in schedules.columns else F.to_date("ingest_ts")
    return latest_partition(schedules, day)


def schedule_headers(schedules: DataFrame) -> DataFrame:
    """Schedules of the newest load with their segment fields, day flags and labels."""
    segment = F.from_json("schedule_segment_json", SCHEDULE_SEGMENT)
    rows = computed_once(_newest_day(schedules), "s", segment)
    return rows.select(
        "train_uid",
        blank_to_null(F.col("s.signalling_id")).alias("train_signalling_id"),
        blank_to_null(F.col("s.CIF_train_service_code")).alias("train_service_code"),
        F.col("s.CIF_train_category").alias("train_category"),
        "stp_indicator",
        code_label(F.col("stp_indicator"), labels.STP_INDICATOR).alias("stp_indicator_desc"),
        "atoc_code",
        "schedule_start_date",
        "schedule_end_date",
        "schedule_days_runs",
        *day_flags(F.col("schedule_days_runs")),
        strict_cast(F.col("s.CIF_speed"), "bigint").alias("planned_speed"),
        "train_status",
        code_label(F.col("train_status"), labels.TRAIN_STATUS).alias("train_status_desc"),
        F.col("s.CIF_operating_characteristics").alias("operating_characteristic"),
        code_label(
            F.col("s.CIF_operating_characteristics"), labels.OPERATING_CHARACTERISTIC, default="UNKNOWN"
        ).alias("operating_characteristic_desc"),
        F.col("s.CIF_power_type").alias("power_type"),
        code_label(F.col("s.CIF_power_type"), labels.POWER_TYPE).alias("power_type_desc"),
        F.col("s.CIF_reservations").alias("reservations"),
        code_label(F.col("s.CIF_reservations"), labels.RESERVATIONS).alias("reservations_desc"),
        "bank_holiday_code",
        code_label(F.col("bank_holiday_code"), labels.BANK_HOLIDAY).alias("bank_holiday_desc"),
        "ingest_ts",
    )


def schedule_stops(schedules: DataFrame) -> DataFrame:
    """One row per stop of the running schedules of the newest load."""
    running = _newest_day(schedules).filter(
        (F.col("stp_indicator") != "C")
        & F.col("applicable_timetable").isNotNull()
        & F.col("schedule_location_json").isNotNull()
    )
    stops = json_array_rows(running, "schedule_location_json", "loc_offset", "loc")
    rows = computed_once(stops, "l", F.from_json("loc", SCHEDULE_LOCATION))

    def time(field: str, name: str) -> Column:
        return hhmm_time(F.col(f"l.{field}")).alias(name)

    def minutes(field: str) -> Column:
        return allowance_minutes(F.col(f"l.{field}")).alias(f"{field}_mins")

    return rows.select(
        "train_uid",
        "schedule_start_date",
        "schedule_end_date",
        "stp_indicator",
        F.col("l.record_identity").alias("location_type"),
        code_label(F.col("l.record_identity"), labels.LOCATION_TYPE).alias("location_type_desc"),
        F.col("loc_offset").cast("bigint").alias("loc_offset"),
        F.col("l.tiploc_code").alias("tiploc_code"),
        safe_cast(F.col("l.tiploc_instance"), "bigint").alias("tiploc_instance"),
        time("arrival", "arrival_working_timetable_time"),
        time("departure", "departure_working_timetable_time"),
        time("public_arrival", "arrival_public_timetable_time"),
        time("public_departure", "departure_public_timetable_time"),
        time("pass", "passing_working_timetable_time"),
        F.col("l.platform").alias("platform"),
        F.col("l.line").alias("line"),
        F.col("l.path").alias("path"),
        minutes("engineering_allowance"),
        minutes("pathing_allowance"),
        minutes("performance_allowance"),
    )


def operators(toc: DataFrame) -> DataFrame:
    """Operators with their type; freight operators (code ZZ) get a code of their own."""
    clean = toc.select(
        F.col("company").alias("toc_name"),
        *[blank_to_null(F.col(c)).alias(c) for c in ("business_code", "sector_code", "atoc_code")],
    )
    freight = F.col("atoc_code") == "ZZ"
    return clean.select(
        "toc_name",
        F.when(freight, "Non-passenger / Freight Operator Type")
        .otherwise("Passenger Operator Type")
        .alias("toc_operator_type"),
        "business_code",
        "sector_code",
        F.when(freight & F.col("toc_name").isNotNull(), slug_code(F.col("toc_name")))
        .otherwise(F.col("atoc_code"))
        .alias("atoc_code"),
    )
