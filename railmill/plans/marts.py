"""Mart models: train status, live trains, route ends, delay records."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railmill.functions import at_time_of_day, concat_or_null, delay_bucket, service_date
from railmill.operators.aggregates import latest_rows
from railmill.operators.dedup import first_and_last, first_k, remaining_order
from railmill.operators.filters import within

TIMES = (
    "arrival_public_timetable_time",
    "departure_public_timetable_time",
    "arrival_working_timetable_time",
    "departure_working_timetable_time",
    "passing_working_timetable_time",
)


def train_status(movements: DataFrame) -> DataFrame:
    """The latest event of every train; events tied at that instant all stay."""
    slim = movements.select(
        "train_id",
        "schedule_id",
        "location_id",
        "next_location_id",
        "toc_id",
        "planned_timestamp",
        "actual_timestamp",
        "event_type",
        "planned_event_type",
        "timetable_variation",
        "variation_status",
    )
    return latest_rows(slim.filter(F.col("train_id").isNotNull()), "train_id", "actual_timestamp").select(*slim.columns)


def planned_positions(status: DataFrame, stops: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Latest events at planned stops with the planned instant of the stop."""
    planned = stops.select("schedule_id", "location_id", *TIMES, "platform", "line").distinct()
    at_stop = status.filter(F.col("train_id").isNotNull()).join(planned, ["schedule_id", "location_id"])
    day = F.coalesce(F.to_date("actual_timestamp"), F.lit(as_of.date()))
    return at_stop.withColumn("scheduled_event_timestamp", at_time_of_day(day, *[F.col(c) for c in TIMES]))


def live_train(
    status: DataFrame,
    stops: DataFrame,
    schedules: DataFrame,
    locations: DataFrame,
    as_of: dt.datetime,
    span: dt.timedelta = dt.timedelta(hours=1),
) -> DataFrame:
    """One row per train whose latest planned position lies within an hour of ``as_of``.

    The latest position is chosen first: a train whose latest position is outside the
    hour does not fall back to an older one.
    """
    trains = schedules.select("schedule_id", "train_uid", "train_signalling_id")
    places = locations.select("location_id", "location_name", "crs_code")
    merged = (
        planned_positions(status, stops, as_of)
        .join(trains, "schedule_id", "left")
        .join(places, "location_id", "left")
        .select(
            "train_id",
            "toc_id",
            "train_uid",
            "train_signalling_id",
            "location_name",
            "crs_code",
            "event_type",
            "planned_event_type",
            "actual_timestamp",
            "planned_timestamp",
            "timetable_variation",
            "variation_status",
            "scheduled_event_timestamp",
            "arrival_public_timetable_time",
            "arrival_working_timetable_time",
            "departure_public_timetable_time",
            "departure_working_timetable_time",
            "passing_working_timetable_time",
            "platform",
            "line",
        )
    )
    newest = [F.col("actual_timestamp").desc_nulls_last(), F.col("scheduled_event_timestamp").desc_nulls_last()]
    used = {"train_id", "actual_timestamp", "scheduled_event_timestamp"}
    latest = first_k(merged, ["train_id"], [*newest, *remaining_order(merged, used)], 1)
    return latest.filter(within(F.col("scheduled_event_timestamp"), as_of, span))


def route_start_stop(
    stops: DataFrame, schedules: DataFrame, locations: DataFrame, per: str = "uid"
) -> DataFrame:
    """Origin and destination of every train uid (of its first schedule), or of every schedule.

    A schedule that starts and ends at one place has no route.
    """
    ends = first_and_last(
        stops.select("schedule_id", "loc_offset", "location_id"),
        ["schedule_id"],
        ["loc_offset"],
        {"location_id": ("origin_id", "terminating_id")},
    ).filter(F.col("origin_id") != F.col("terminating_id"))
    names = locations.select("location_id", "location_name")
    origin = names.select(F.col("location_id").alias("origin_id"), F.col("location_name").alias("origin"))
    last = names.select(F.col("location_id").alias("terminating_id"), F.col("location_name").alias("terminating"))
    routes = (
        ends.join(schedules.select("schedule_id", "train_uid"), "schedule_id", "left")
        .join(origin, "origin_id", "left")
        .join(last, "terminating_id", "left")
        .select(
            "schedule_id",
            "train_uid",
            "origin",
            "terminating",
            concat_or_null(F.col("origin"), F.lit("-"), F.col("terminating")).alias("route_desc"),
        )
    )
    if per == "schedule":
        return routes
    return first_k(routes, ["train_uid"], ["schedule_id", "origin", "terminating"], 1)


def train_delay(
    movements: DataFrame,
    stops: DataFrame,
    schedules: DataFrame,
    routes: DataFrame,
    locations: DataFrame,
    tocs: DataFrame,
) -> DataFrame:
    """Distinct delay records of movements at planned stops."""
    planned = stops.select("schedule_id", "location_id", "location_type_desc").distinct()
    events = movements.filter(F.col("train_id").isNotNull() & F.col("actual_timestamp").isNotNull()).select(
        "schedule_id",
        "location_id",
        "next_location_id",
        "toc_id",
        "train_id",
        "actual_timestamp",
        "planned_timestamp",
        "event_type",
        "timetable_variation",
        "next_report_run_time",
    )
    trains = schedules.select("schedule_id", "train_uid", "train_signalling_id", "stp_indicator", "train_category")
    here = locations.select("location_id", F.col("station_id").alias("_here"), "location_name")
    ahead = locations.select(
        F.col("location_id").alias("next_location_id"),
        F.col("station_id").alias("_ahead"),
        F.col("location_name").alias("next_location_name"),
    )
    joined = (
        events.join(planned, ["schedule_id", "location_id"])
        .join(trains, "schedule_id", "left")
        .join(routes.select("train_uid", "route_desc"), "train_uid", "left")
        .join(here, "location_id", "left")
        .join(ahead, "next_location_id", "left")
        .join(tocs.select("toc_id", "toc_name"), "toc_id", "left")
    )
    return joined.select(
        service_date(F.col("planned_timestamp")).alias("service_date"),
        "actual_timestamp",
        "planned_timestamp",
        "toc_name",
        "train_id",
        "train_uid",
        "route_desc",
        "train_signalling_id",
        "stp_indicator",
        "train_category",
        F.col("_here").alias("location_id"),
        "location_name",
        F.col("_ahead").alias("next_location_id"),
        "next_location_name",
        "location_type_desc",
        "event_type",
        "timetable_variation",
        delay_bucket(F.col("timetable_variation")).alias("delay_category"),
        "next_report_run_time",
    ).distinct()
