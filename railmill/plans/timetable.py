"""Timetable queries: trains running on a date, their routes, searches, associations.

The working form of a route is one row per stop. Arrays are built only for callers that
want a route as one row.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railmill.functions import at_time_of_day, runs_on
from railmill.functions.labels import MISSING_TEXT
from railmill.operators.aggregates import PAGE_ROWS, ordered_pages
from railmill.operators.dedup import first_and_last, first_k, remaining_order
from railmill.operators.filters import facet_filter, optional_equals, within

ROUTE = [
    "train_uid", "stp", "toc_name", "train_signalling_id", "train_status_desc", "train_category",
    "train_category_desc", "reservations_desc", "operating_characteristic_desc", "planned_speed", "power_type_desc",
]
STOP = ["location_name", "location_type_desc", "longitude", "latitude", "arr_pub", "dep_pub", "arr_wtt", "dep_wtt", "pass_wtt", "platform"]
TIME_COLUMNS = {
    "arrival_public_timetable_time": "arr_pub",
    "departure_public_timetable_time": "dep_pub",
    "arrival_working_timetable_time": "arr_wtt",
    "departure_working_timetable_time": "dep_wtt",
    "passing_working_timetable_time": "pass_wtt",
}


def train_uids_on(schedules: DataFrame, day: dt.date, facets: dict[str, list[str]] | None = None) -> DataFrame:
    """Trains running on a date with their light attributes, in uid order."""
    light = ("train_category", "train_status_desc", "power_type_desc")
    running = schedules.filter(runs_on(day, "schedule_start_date", "schedule_end_date"))
    rows = running.select("train_uid", *[F.coalesce(F.col(c), F.lit("UNKNOWN")).alias(c) for c in light])
    return facet_filter(rows.distinct(), facets or {}).orderBy("train_uid", *light)


def route_stops(
    stops: DataFrame,
    schedules: DataFrame,
    geo: DataFrame,
    tocs: DataFrame,
    day: dt.date,
    train_uid: str | None = None,
    trains: DataFrame | None = None,
) -> DataFrame:
    """One row per located stop of every route running on a date.

    ``train_uid`` picks one train; ``trains`` (a frame with a ``train_uid`` column) many.
    The schedule filters reach the scan before anything is joined.
    """
    running = optional_equals(schedules, "train_uid", train_uid).filter(
        runs_on(day, "schedule_start_date", "schedule_end_date")
    )
    if trains is not None:
        running = running.join(trains.select("train_uid"), "train_uid", "left_semi")
    located = geo.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).select(
        "location_id", "location_name", "longitude", "latitude"
    )
    names = tocs.select("toc_name", "toc_schedule_code")
    times = [F.col(c).alias(n) for c, n in TIME_COLUMNS.items()]
    planned = stops.select("schedule_id", "location_id", "loc_offset", "location_type_desc", *times, "platform")
    heads = running.join(names, F.col("atoc_code") == F.col("toc_schedule_code"), "left").withColumn(
        "stp", F.col("short_term_planning_schedule_indicator")
    )
    return (
        planned.join(heads.select("schedule_id", *ROUTE), "schedule_id")
        .join(located, "location_id")
        .select(*ROUTE, "loc_offset", *STOP)
    )


def _same_route(left: DataFrame, right: DataFrame) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[f"_{c}"]) for c in ROUTE])


def _calling_at(stop_rows: DataFrame, station: str) -> DataFrame:
    """Stop rows of the routes that call at a station."""
    chosen = stop_rows.filter(F.col("location_name") == station)
    routes = chosen.select(*[F.col(c).alias(f"_{c}") for c in ROUTE]).distinct()
    return stop_rows.join(routes, _same_route(stop_rows, routes), "left_semi")


def route_meta(stop_rows: DataFrame, station: str | None = None, page_rows: int = PAGE_ROWS) -> DataFrame:
    """One row per route with the stops, path and timetable as arrays in stop order.

    A station keeps only the routes that call there, before any array is built. A route
    of more than ``page_rows`` stops comes in several pages.
    """
    rows = stop_rows if station is None else _calling_at(stop_rows, station)
    paged = ordered_pages(rows, ROUTE, ["loc_offset"], STOP, page_rows)

    def column(field: str, missing: str | None = None) -> Column:
        value = (lambda s: s[field]) if missing is None else (lambda s: F.coalesce(s[field], F.lit(missing)))
        return F.transform("items", value)

    points = F.transform(
        "items", lambda s: F.struct(s["longitude"].alias("longitude"), s["latitude"].alias("latitude"))
    )
    return paged.select(
        *ROUTE,
        "page",
        column("location_name").alias("stops"),
        column("location_type_desc").alias("stops_type"),
        points.alias("route_path"),
        *[
            column(name, MISSING_TEXT).alias(f"tt_{name}")
            for name in ("arr_pub", "dep_pub", "arr_wtt", "dep_wtt", "pass_wtt")
        ],
        column("platform", MISSING_TEXT).alias("platforms"),
    )


def timetable_rows(meta: DataFrame, page_rows: int = PAGE_ROWS) -> DataFrame:
    """Arrays of a route back to one row per stop, as the timetable view shows them.

    ``page_rows`` is that of the pages: stops are numbered through all pages of a route.
    """
    arrays = {
        "stops": "station",
        "platforms": "platform",
        "stops_type": "type",
        "tt_arr_pub": "arr_public",
        "tt_dep_pub": "dep_public",
        "tt_arr_wtt": "arr_timetable",
        "tt_dep_wtt": "dep_timetable",
        "tt_pass_wtt": "pass_timetable",
    }
    zipped = F.arrays_zip(*[F.col(a).alias(n) for a, n in arrays.items()])
    stops = meta.select(*ROUTE, "page", F.posexplode(zipped).alias("at", "s"))
    number = (F.col("page") * page_rows + F.col("at")).cast("int").alias("stop_no")
    return stops.select(*ROUTE, "page", number, "s.*")


def station_search(
    stop_rows: DataFrame, station: str, at: dt.datetime, window_minutes: int, strict: bool = False
) -> DataFrame:
    """Routes calling at a station within minutes of a moment, with their ends.

    The time shown is departure, else arrival, else passing time at the first call.
    ``strict`` shows only public departures, as the older search did.
    """
    calls = stop_rows.filter(F.col("location_name") == station)
    order = [F.col("loc_offset"), *remaining_order(calls, {*ROUTE, "loc_offset"})]
    first_call = first_k(calls, ROUTE, order, 1)
    shown = [F.col("dep_pub")] if strict else [F.col("dep_pub"), F.col("arr_pub"), F.col("pass_wtt")]
    timed = first_call.withColumn("display_time", at_time_of_day(F.lit(at.date()), *shown))
    hits = timed.filter(within(F.col("display_time"), at, dt.timedelta(minutes=window_minutes)))
    found = hits.select(
        *[F.col(c).alias(f"_{c}") for c in ROUTE],
        F.coalesce("platform", F.lit(MISSING_TEXT)).alias("platform"),
        "display_time",
    )
    names = stop_rows.select(*ROUTE, "loc_offset", "location_name")
    routes = found.select(*[f"_{c}" for c in ROUTE])
    of_hits = names.join(routes, _same_route(names, routes), "left_semi")
    ends = first_and_last(of_hits, ROUTE, ["loc_offset"], {"location_name": ("origin_stop", "last_stop")})
    return (
        ends.join(found, _same_route(ends, found))
        .select("train_uid", "platform", "origin_stop", "last_stop", "display_time")
        .orderBy("display_time", "train_uid", "platform", "origin_stop", "last_stop")
    )


def associations_on(associations: DataFrame, day: dt.date, train_uid: str | None = None) -> DataFrame:
    """Trains associated with a train on a date."""
    chosen = optional_equals(associations, "main_train_uid", train_uid)
    running = chosen.filter(runs_on(day, "assoc_start_date", "assoc_end_date"))
    return running.select("assoc_train_uid", "associated_type", "assoc_location").distinct()


def associated_routes(
    associations: DataFrame,
    stops: DataFrame,
    schedules: DataFrame,
    geo: DataFrame,
    tocs: DataFrame,
    day: dt.date,
    train_uid: str | None = None,
) -> DataFrame:
    """Stops of all trains associated with one train, the place of association marked."""
    links = associations_on(associations, day, train_uid)
    uids = links.select(F.col("assoc_train_uid").alias("train_uid")).distinct()
    rows = route_stops(stops, schedules, geo, tocs, day, trains=uids)
    places = rows.select(F.col("train_uid").alias("assoc_train_uid"), "loc_offset", "location_name", "longitude", "latitude")
    return links.join(places, "assoc_train_uid").withColumn(
        "is_association_place", F.coalesce(F.col("location_name") == F.col("assoc_location"), F.lit(False))
    )


def stations_with_coordinates(geo: DataFrame) -> DataFrame:
    return geo.filter(F.col("latitude").isNotNull()).select("location_id", "location_name", "latitude", "longitude")
