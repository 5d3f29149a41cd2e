"""Core models: dimensions, bridges and facts.

``run_ts`` stamps the rows of a run; it is a parameter so that a rerun gives the same
table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railmill.functions import (
    area_of_station,
    code_label,
    concat_or_null,
    day_flags,
    labels,
    safe_cast,
    sector_code_number,
    strict_cast,
    surrogate_key,
    text_from,
    unknown_key,
)
from railmill.operators.dedup import first_k, keep_by_priority, remaining_order
from railmill.operators.joins import equal_on, in_two_roles, interval_join, or_unknown, with_unknown_member

SCHEDULE_MATCH = [
    ("train_uid", "train_uid"),
    ("schedule_start_date", "schedule_start_date"),
    ("schedule_end_date", "schedule_end_date"),
    ("schedule_type", "stp_indicator"),
]


def _stamp(run_ts: dt.datetime) -> Column:
    return F.lit(run_ts).alias("dbt_updated_at")


def dim_location(
    scheduled: DataFrame, reference: DataFrame, run_ts: dt.datetime, padded_area: bool = False
) -> DataFrame:
    """Places of both sources, the reference before the timetable, plus the Unknown place."""
    both = (
        scheduled.filter(F.col("station_id").isNotNull())
        .withColumn("source_system", F.lit("schedule"))
        .unionByName(
            reference.filter(F.col("station_id").isNotNull() & F.col("location_name").isNotNull()).withColumn(
                "source_system", F.lit("trust")
            )
        )
    )
    rows = keep_by_priority(both, ["station_id", "tiploc_code"], "source_system", ["trust"])
    dim = rows.select(
        surrogate_key("station_id", "tiploc_code", "nlc_code").alias("location_id"),
        "station_id",
        area_of_station(F.col("station_id"), padded_area).alias("geographical_id"),
        "tiploc_code",
        "crs_code",
        "nlc_code",
        "location_name",
        "source_system",
        _stamp(run_ts),
        F.lit(True).alias("is_active"),
    )
    return with_unknown_member(
        dim,
        {
            "location_id": unknown_key(),
            "station_id": -1,
            "geographical_id": -1,
            "tiploc_code": "Unknown Tiploc Code",
            "crs_code": "Unknown CRS Code",
            "nlc_code": -1,
            "location_name": "Unknown Location",
            "source_system": "system",
            "dbt_updated_at": run_ts,
            "is_active": False,
        },
    )


def one_place_per_station(locations: DataFrame) -> DataFrame:
    """One place per station: the greatest timing-point code."""
    order = [F.col("tiploc_code").desc_nulls_last()]
    return first_k(locations, ["station_id"], [*order, *remaining_order(locations, {"station_id"})], 1)


def dim_geo(locations: DataFrame, stops: DataFrame, run_ts: dt.datetime, prefix: str | None = None) -> DataFrame:
    """One place per station with the coordinates of its public stop.

    The match drops the first four characters of the stop code whatever they are, so a
    code may match stops of several kinds; ``prefix`` (such as ``9100``) admits one kind.
    """
    places = one_place_per_station(locations)
    points = stops.select(
        text_from(F.col("ATCOCode"), 5).alias("_code"),
        F.col("ATCOCode").alias("_atco"),
        F.col("Latitude").alias("latitude"),
        F.col("Longitude").alias("longitude"),
        "Easting",
        "Northing",
        "StopType",
    )
    if prefix:
        points = points.filter(F.col("_atco").startswith(prefix))
    joined = places.join(points, F.col("tiploc_code") == F.col("_code"), "left")
    return joined.select(
        "location_id",
        "tiploc_code",
        "crs_code",
        "location_name",
        "station_id",
        F.concat(F.lit("9100"), "tiploc_code").alias("atco_code"),
        "latitude",
        "longitude",
        concat_or_null(F.col("latitude"), F.lit(","), F.col("longitude")).alias("coordinates"),
        "Easting",
        "Northing",
        "StopType",
        "source_system",
        _stamp(run_ts),
    )


def dim_toc(operators: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Operators plus the Unknown operator."""
    dim = operators.select(
        surrogate_key("toc_name").alias("toc_id"),
        "toc_name",
        F.col("business_code").alias("toc_business_code"),
        sector_code_number(F.col("sector_code")).alias("toc_operating_code"),
        F.col("atoc_code").alias("toc_schedule_code"),
        _stamp(run_ts),
        F.lit(True).alias("is_active"),
    )
    return with_unknown_member(
        dim,
        {
            "toc_id": unknown_key(),
            "toc_name": "Unknown TOC Name",
            "toc_business_code": "Unknown Business Code",
            "toc_schedule_code": "ZZ",
            "dbt_updated_at": run_ts,
            "is_active": False,
        },
    )


def dim_area(td_area: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Signalling areas with their feature flags."""
    flags = {
        "sig": "signal_aspects",
        "rte": "route_set_indications",
        "lat": "latch_indications",
        "trk": "track_occupation_indicator",
        "pts": "points_indicator",
        "lxg": "level_crossing_barrier_indicator",
    }
    return td_area.filter(F.col("area_id").isNotNull()).select(
        surrogate_key("area_id", "name").alias("td_area_id"),
        "area_id",
        F.col("name").alias("area_name"),
        *[strict_cast(F.col(c), "boolean").alias(name) for c, name in flags.items()],
        F.lit(True).alias("is_active"),
        _stamp(run_ts),
    )


def dim_signal_berth(td_smart: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Berth steps plus the Unknown step. Lettered platforms and routes become null numbers."""
    numbers = {c: safe_cast(F.col(c), "bigint") for c in ("berth_offset", "platform", "route")}
    dim = td_smart.filter(F.col("td").isNotNull()).select(
        surrogate_key("stanox", "td", "from_berth", "to_berth", "step_type", "route").alias("signal_berth_id"),
        F.col("td").alias("area_id"),
        safe_cast(F.col("stanox"), "bigint").alias("station_id"),
        F.col("stanme").alias("station_name"),
        "step_type",
        "from_berth",
        "to_berth",
        numbers["berth_offset"].alias("berth_offset"),
        "event",
        numbers["platform"].alias("platform"),
        "from_line",
        "to_line",
        numbers["route"].alias("route"),
        "comment",
        F.lit(True).alias("is_active"),
        _stamp(run_ts),
    )
    return with_unknown_member(dim, {"signal_berth_id": unknown_key(), "is_active": True, "dbt_updated_at": run_ts})


def dim_train_schedule(headers: DataFrame, categories: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """Schedules with category names."""
    names = categories.select(
        F.col("Code").alias("_code"), F.col("Category").alias("_name"), F.col("Description").alias("_description")
    )
    joined = headers.join(names, F.col("train_category") == F.col("_code"), "left")
    identity = [
        "train_uid", "train_signalling_id", "train_service_code", "schedule_start_date", "schedule_end_date",
        "stp_indicator",
    ]
    return joined.select(
        surrogate_key(*identity).alias("schedule_id"),
        "train_uid",
        "train_signalling_id",
        "train_service_code",
        "atoc_code",
        "stp_indicator",
        F.col("stp_indicator_desc").alias("short_term_planning_schedule_indicator"),
        "schedule_start_date",
        "schedule_end_date",
        "planned_speed",
        F.col("_name").alias("train_category"),
        F.col("_description").alias("train_category_desc"),
        "train_status_desc",
        "reservations_desc",
        "operating_characteristic_desc",
        "power_type_desc",
        *labels.DAY_FLAGS,
        "bank_holiday_desc",
        _stamp(run_ts),
    )


def dim_train_association(associations: DataFrame) -> DataFrame:
    return associations.select(
        "association_id",
        "main_train_uid",
        "assoc_train_uid",
        "assoc_start_date",
        "assoc_end_date",
        code_label(F.col("assoc_category"), labels.ASSOCIATION_TYPE).alias("associated_type"),
        code_label(F.col("date_indicator"), labels.ASSOCIATION_DATE).alias("associated_date_indicator"),
        *day_flags(F.col("assoc_days")),
        "assoc_location",
        "base_location_suffix",
        "assoc_location_suffix",
    )


def bridge_td_to_schedule(describer: DataFrame, schedules: DataFrame) -> DataFrame:
    """Signalling ids seen in the berth feed with the schedules that use them."""
    columns = ["schedule_id", "train_uid", "train_signalling_id", "schedule_start_date", "schedule_end_date"]
    seen = (
        describer.filter(F.col("train_signalling_id").isNotNull() & (F.col("msg_type") != "CT"))
        .select("train_signalling_id")
        .distinct()
    )
    planned = schedules.filter(F.col("train_signalling_id").isNotNull()).select(*columns).distinct()
    # planned grows with the timetable, but the files it is parsed from look small enough to send through the driver
    bridge = seen.join(planned.hint("merge"), "train_signalling_id", "left").select(
        surrogate_key("train_signalling_id", "schedule_id", "schedule_start_date", "schedule_end_date").alias(
            "bridge_id"
        ),
        "train_signalling_id",
        "train_uid",
        "schedule_id",
        "schedule_start_date",
        "schedule_end_date",
    )
    return with_unknown_member(bridge, {"bridge_id": unknown_key()})


def bridge_signal_berth_to_location(berths: DataFrame, locations: DataFrame, run_ts: dt.datetime) -> DataFrame:
    left = berths.filter(F.col("station_id").isNotNull()).select("signal_berth_id", "station_id")
    right = locations.filter(F.col("station_id").isNotNull()).select("location_id", "station_id")
    return left.join(right, "station_id").select(
        surrogate_key("signal_berth_id", "location_id").alias("signal_location_bridge_id"),
        "signal_berth_id",
        "location_id",
        F.lit(True).alias("is_active"),
        _stamp(run_ts),
    )


def _scheduled_activations(activations: DataFrame, schedules: DataFrame) -> DataFrame:
    """Activations with the schedule of their uid, validity and type; others fall away.

    Both sides grow with the timetable, so neither is sent through the driver, however small its files look.
    """
    right = schedules.select("schedule_id", *[b for _, b in SCHEDULE_MATCH])
    return activations.alias("a").join(right.hint("merge").alias("d"), equal_on("a", "d", SCHEDULE_MATCH))


def fact_activation(activations: DataFrame, schedules: DataFrame, tocs: DataFrame, run_ts: dt.datetime) -> DataFrame:
    operator = tocs.select(F.col("toc_id").alias("_toc_key"), "toc_operating_code")
    matched = _scheduled_activations(activations.filter(F.col("train_id").isNotNull()), schedules)
    joined = matched.select("a.*", F.col("d.schedule_id").alias("schedule_id")).join(
        operator, F.col("toc_id") == F.col("toc_operating_code"), "left"
    )
    return joined.select(
        surrogate_key("schedule_id", "_toc_key", "train_id", "schedule_start_date", "schedule_end_date").alias(
            "activation_id"
        ),
        "schedule_id",
        F.col("_toc_key").alias("toc_id"),
        "train_id",
        "train_service_code",
        "schedule_wtt_id",
        "sched_origin_stanox",
        "tp_origin_stanox",
        "tp_origin_timestamp",
        "origin_dep_timestamp",
        "train_call_type",
        "train_call_mode",
        "user_id",
        "original_data_source",
        "source_system_id",
        "msg_queue_timestamp",
        "ingest_ts",
        F.lit(True).alias("is_active"),
        _stamp(run_ts),
    )


def fact_movement(
    movements: DataFrame,
    activations: DataFrame,
    schedules: DataFrame,
    locations: DataFrame,
    tocs: DataFrame,
    run_ts: dt.datetime,
    dedupe_locations: bool = False,
) -> DataFrame:
    """Movements of activated, scheduled trains of known operators, with their place keys.

    A station with several timing points fans a movement out over them, in either role;
    ``dedupe_locations`` keeps one place per station instead.
    """
    trains = _scheduled_activations(activations, schedules).select("a.train_id", "d.schedule_id")
    places = one_place_per_station(locations) if dedupe_locations else locations
    operator = tocs.select(F.col("toc_id").alias("_toc_key"), "toc_operating_code")
    known = movements.join(operator, F.col("toc_id") == F.col("toc_operating_code")).join(trains.hint("merge"), "train_id")
    joined = in_two_roles(
        known,
        places,
        ("loc_stanox", "next_report_stanox"),
        "station_id",
        {"location_id": ("_location", "_next_location")},
    )
    return joined.select(
        surrogate_key("train_id", "schedule_id", "_location", "_next_location", "_toc_key", "actual_timestamp").alias(
            "train_movement_id"
        ),
        "train_id",
        or_unknown(F.col("schedule_id")).alias("schedule_id"),
        or_unknown(F.col("_location")).alias("location_id"),
        or_unknown(F.col("_next_location")).alias("next_location_id"),
        or_unknown(F.col("_toc_key")).alias("toc_id"),
        "route",
        "platform",
        "loc_stanox",
        "next_report_stanox",
        "reporting_stanox",
        "actual_timestamp",
        "planned_timestamp",
        "planned_event_type",
        "event_type",
        "timetable_variation",
        "variation_status",
        "next_report_run_time",
        "correction_ind",
        "offroute_ind",
        "train_terminated",
        "delay_monitoring_point",
        "auto_expected",
        "event_source",
        "msg_type",
        "ingest_ts",
        F.lit(True).alias("is_active"),
        _stamp(run_ts),
    )


def fact_berth_events(describer: DataFrame, areas: DataFrame, berths: DataFrame, bridge: DataFrame) -> DataFrame:
    """Berth steps of trains with a schedule valid on the day of the step.

    A step meets every schedule of its signalling id, so the rows multiply there. That join comes last: what it
    makes is neither shuffled nor sorted again. What can be made of a step alone is made before it: the text of its time
    costs more than the rest of a row's key.
    """
    steps = describer.filter((F.col("msg_type") != "CT") & F.col("train_signalling_id").isNotNull())
    steps = steps.select("area_id", "from_berth", "to_berth", "train_signalling_id", "event_ts", "ingest_ts", "msg_type", "report_time")
    area = areas.select("td_area_id", F.col("area_id").alias("_area"))
    berth = berths.select(
        "signal_berth_id",
        F.col("area_id").alias("_berth_area"),
        F.col("from_berth").alias("_from"),
        F.col("to_berth").alias("_to"),
    )
    step = (
        (F.col("area_id") == F.col("_berth_area"))
        & (F.col("from_berth") == F.col("_from"))
        & (F.col("to_berth") == F.col("_to"))
    )
    placed = steps.join(area, F.col("area_id") == F.col("_area"), "left").join(berth, step, "left")
    placed = placed.select(
        "td_area_id", "signal_berth_id", "train_signalling_id", "event_ts", "ingest_ts", "msg_type", "report_time",
        F.col("event_ts").cast("string").alias("_event_text"),
    )
    dated = interval_join(
        placed,
        bridge.filter(F.col("train_uid").isNotNull()).select(
            "bridge_id", "schedule_id", "train_uid", "train_signalling_id", "schedule_start_date", "schedule_end_date"
        ).hint("merge"),
        [("train_signalling_id", "train_signalling_id")],
        F.to_date("event_ts"),
        "schedule_start_date",
        "schedule_end_date",
    ).select("p.*", "r.bridge_id", "r.schedule_id", "r.train_uid")
    return dated.select(
        surrogate_key("td_area_id", "signal_berth_id", "bridge_id", "_event_text").alias("event_id"),
        "td_area_id",
        or_unknown(F.col("signal_berth_id")).alias("signal_berth_id"),
        or_unknown(F.col("bridge_id")).alias("bridge_id"),
        "schedule_id",
        "train_uid",
        "train_signalling_id",
        "event_ts",
        "ingest_ts",
        "msg_type",
        "report_time",
    )


def fact_scheduled_location(stops: DataFrame, locations: DataFrame, schedules: DataFrame) -> DataFrame:
    """Planned stops with their schedule and place keys."""
    match = ["train_uid", "schedule_start_date", "schedule_end_date", "stp_indicator"]
    running = schedules.filter(F.col("stp_indicator") != "C").select("schedule_id", *match)
    places = locations.select("location_id", "tiploc_code")
    joined = (
        stops.filter(F.col("stp_indicator") != "C").join(running.hint("merge"), match, "left").join(places, "tiploc_code", "left")
    )
    return joined.select(
        surrogate_key(
            "schedule_id",
            "location_id",
            "loc_offset",
            "location_type_desc",
            "arrival_working_timetable_time",
            "departure_working_timetable_time",
            "departure_public_timetable_time",
            "arrival_public_timetable_time",
            "passing_working_timetable_time",
        ).alias("scheduled_location_id"),
        or_unknown(F.col("schedule_id")).alias("schedule_id"),
        or_unknown(F.col("location_id")).alias("location_id"),
        "loc_offset",
        "location_type_desc",
        "arrival_working_timetable_time",
        "departure_working_timetable_time",
        "arrival_public_timetable_time",
        "departure_public_timetable_time",
        "passing_working_timetable_time",
        "platform",
        "line",
        "path",
        "engineering_allowance_mins",
        "pathing_allowance_mins",
        "performance_allowance_mins",
    )
