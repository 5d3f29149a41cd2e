"""Models on hand-written rail rows: the hazards of the inputs, one by one."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from railmill.functions import labels
from railmill.plans import core, intermediate, live, marts, performance, staging, timetable

TS1, TS2 = dt.datetime(2024, 1, 9, 2), dt.datetime(2024, 1, 10, 2)
RUN = TS2
UNKNOWN = "88183b946cc5f0e8c96b2e66e1c74a7e"  # md5 of "Unknown"


def raw(spark, *records):
    return spark.createDataFrame(
        [(kind, json.dumps(payload), ts) for kind, payload, ts in records],
        "record_type string, payload string, ingest_ts timestamp",
    )


def schedule_payload(uid="U1", stp="P", start="2024-01-01", end="2024-01-31", locations=True, **segment):
    segment = {"signalling_id": "1A23", "CIF_train_service_code": " ", "CIF_speed": "090", **segment}
    if locations:
        segment["schedule_location"] = [
            {"record_identity": "LO", "tiploc_code": "AAA", "departure": "0930H", "public_departure": "0930", "platform": "2"},
            {"record_identity": "LI", "tiploc_code": "BBB", "pass": "1000", "engineering_allowance": "1H"},
            {"record_identity": "LT", "tiploc_code": "CCC", "arrival": "1030", "public_arrival": "", "tiploc_instance": "2"},
        ]
    return {
        "CIF_train_uid": uid, "schedule_start_date": start, "schedule_end_date": end, "schedule_days_runs": "1111100",
        "CIF_stp_indicator": stp, "train_status": "P", "atoc_code": "AA", "applicable_timetable": "Y",
        "schedule_segment": segment,
    }


@pytest.fixture
def schedules(spark):
    kind = "JsonScheduleV1"
    return staging.schedule(
        raw(
            spark,
            (kind, schedule_payload(CIF_power_type="OLD"), TS1),
            (kind, schedule_payload(CIF_power_type="EMU"), TS2),
            (kind, schedule_payload("U2", "C"), TS2),
            (kind, schedule_payload("U3", locations=False), TS2),
            (kind, schedule_payload("U4"), TS1),
            ("TiplocV1", {"tiploc_code": "AAA"}, TS2),
        )
    )


def test_newest_schedule_wins_and_only_the_newest_day_is_read(schedules):
    assert rows(schedules.select("train_uid", "ingest_ts")) == [("U1", TS2), ("U2", TS2), ("U3", TS2), ("U4", TS1)]
    headers = intermediate.schedule_headers(schedules)
    assert rows(headers.select("train_uid", "power_type_desc", "planned_speed", "train_service_code")) == [
        ("U1", "Electric Multiple Unit", 90, None), ("U2", None, 90, None), ("U3", None, 90, None)
    ]
    assert headers.first().operating_characteristic_desc == "UNKNOWN"
    assert [headers.first()[f] for f in labels.DAY_FLAGS] == [True] * 5 + [False] * 2


def test_stops_of_running_schedules(schedules):
    stops = intermediate.schedule_stops(schedules)
    assert rows(stops.select("train_uid", "loc_offset", "tiploc_code")) == [("U1", 0, "AAA"), ("U1", 1, "BBB"), ("U1", 2, "CCC")]
    first, second, third = stops.orderBy("loc_offset").collect()
    assert (first.departure_working_timetable_time, first.departure_public_timetable_time) == ("09:30:00", "09:30:00")
    assert (second.passing_working_timetable_time, second.engineering_allowance_mins) == ("10:00:00", 1.5)
    assert third.arrival_public_timetable_time is None and third.tiploc_instance == 2


def test_run_date_limits_staging(spark):
    dump = raw(spark, ("JsonScheduleV1", schedule_payload("U1"), TS1), ("JsonScheduleV1", schedule_payload("U2"), TS2))
    assert rows(staging.schedule(dump, dt.date(2024, 1, 10)).select("train_uid")) == [("U2",)]


@pytest.fixture
def places(spark):
    scheduled = spark.createDataFrame(
        [(1, "AAA", 10, "AAX", "ALPHA"), (1, "AAB", 11, None, "ALPHA YARD"), (2, "BBB", 20, None, "BETA"), (None, "NNN", 9, None, "NONE")],
        "station_id bigint, tiploc_code string, nlc_code bigint, crs_code string, location_name string",
    )
    reference = spark.createDataFrame(
        [(2, "BBB", 21, "BBX", "BETA REF"), (3, "CCC", 30, None, None), (12345, "DDD", 40, None, "DELTA")], scheduled.schema
    )
    return core.dim_location(scheduled, reference, RUN)


def test_locations(places):
    got = places.select("station_id", "tiploc_code", "location_name", "source_system", "geographical_id")
    assert rows(got) == sorted(
        [
            (1, "AAA", "ALPHA", "schedule", 1), (1, "AAB", "ALPHA YARD", "schedule", 1), (2, "BBB", "BETA REF", "trust", 2),
            (12345, "DDD", "DELTA", "trust", 12), (-1, "Unknown Tiploc Code", "Unknown Location", "system", -1),
        ],
        key=repr,
    )
    assert places.filter("station_id = -1").first().location_id == UNKNOWN
    assert rows(core.one_place_per_station(places).filter("station_id = 1").select("tiploc_code")) == [("AAB",)]


def test_geo_matches_any_stop_kind_unless_a_prefix_is_given(spark, places):
    stops = spark.createDataFrame(
        [("9100AAB", 1.0, 50.0), ("9400AAB", 2.0, 51.0)], "ATCOCode string, Longitude double, Latitude double"
    ).withColumns({"Easting": F.lit(1), "Northing": F.lit(2), "StopType": F.lit("RLY")})
    everything = core.dim_geo(places, stops, RUN)
    assert everything.filter("station_id = 1").count() == 2
    rail = core.dim_geo(places, stops, RUN, prefix="9100").filter("station_id = 1").first()
    assert (rail.latitude, rail.longitude, rail.coordinates, rail.atco_code) == (50.0, 1.0, "50.0,1.0", "9100AAB")


def test_operators(spark):
    toc = spark.createDataFrame(
        [("Fast Trains", " FT", " ?", " FT"), ("Big Freight (UK)", "BF", "88", " ZZ"), ("Copy", "", " 88", "CP"), (None, "x", " ", "ZZ")],
        "company string, business_code string, sector_code string, atoc_code string",
    )
    dim = core.dim_toc(intermediate.operators(toc), RUN)
    got = dim.select("toc_name", "toc_operating_code", "toc_schedule_code", "is_active")
    assert rows(got) == sorted(
        [
            ("Fast Trains", 100, "FT", True), ("Big Freight (UK)", 88, "ZZ_big_freight_uk_", True), ("Copy", 88, "CP", True),
            (None, None, "ZZ", True), ("Unknown TOC Name", None, "ZZ", False),
        ],
        key=repr,
    )


def test_berths_with_lettered_platform(spark):
    columns = ["step_type", "from_berth", "to_berth", "stanox", "event", "platform", "to_line", "berth_offset", "route", "from_line", "td", "comment", "stanme"]
    smart = spark.createDataFrame(
        [("B", "1", "2", "00123", "A", "2A", "", "+10", "1", "", "SK", "", "X"), ("B", "1", "2", "5", "A", "3", "", "0", "", "", None, "", "X")],
        ", ".join(f"{c} string" for c in columns),
    )
    dim = core.dim_signal_berth(smart, RUN)
    assert rows(dim.select("station_id", "platform", "berth_offset", "route")) == [(123, None, 10, 1), (None, None, None, None)]
    assert dim.filter("signal_berth_id = '" + UNKNOWN + "'").count() == 1


@pytest.fixture
def trains(schedules, spark):
    categories = spark.createDataFrame([("XX", "Express", "Fast")], "Code string, Category string, Description string")
    return core.dim_train_schedule(intermediate.schedule_headers(schedules), categories, RUN)


def activation(spark, *data):
    return spark.createDataFrame(
        [(t, uid, kind, "2024-01-01", "2024-01-31", toc, TS2) for t, uid, kind, toc in data],
        "train_id string, train_uid string, schedule_type string, schedule_start_date string, schedule_end_date string, toc_id bigint, ingest_ts timestamp",
    ).withColumns(
        {c: F.lit(None).cast("timestamp") for c in staging.ACTIVATION_TIMES}
        | {c: F.lit(None).cast("string") for c in ("train_service_code", "schedule_wtt_id", "train_call_type", "train_call_mode", "user_id", "original_data_source", "source_system_id")}
        | {c: F.lit(None).cast("bigint") for c in ("sched_origin_stanox", "tp_origin_stanox")}
    )


def movement(spark, *data):
    typed = spark.createDataFrame(
        data,
        "train_id string, loc_stanox bigint, next_report_stanox bigint, toc_id bigint, actual_timestamp timestamp, event_type string, timetable_variation bigint, ingest_ts timestamp",
    )
    missing = [c for c in staging.MOVEMENT_COLUMNS if c not in typed.columns]
    kinds = {c: "boolean" for c in staging.MOVEMENT_FLAGS} | {c: "bigint" for c in staging.MOVEMENT_NUMBERS}
    return typed.withColumns({c: F.lit(None).cast(kinds.get(c, "string")) for c in missing})


@pytest.fixture
def facts(spark, trains, places):
    toc = spark.createDataFrame([("One", "O", "7", "OO"), ("Two", "T", "8", "TT")], "company string, business_code string, sector_code string, atoc_code string")
    tocs = core.dim_toc(intermediate.operators(toc), RUN)
    at = dt.datetime(2024, 1, 10, 9, 30)
    later = at + dt.timedelta(minutes=30)
    activations = staging.activation(activation(spark, ("t1", "U1", "P", 7), ("t2", "U2", "C", 8), ("t3", "U9", "P", 7), (None, "U1", "P", 7)))
    movements = staging.movement(
        movement(
            spark,
            ("t1", 1, 2, 7, at, "DEPARTURE", 6, TS1),
            ("t1", 1, 2, 7, at, "ARRIVAL", -1, TS2),  # same place and instant, newer
            ("t1", 2, 99, 7, later, "ARRIVAL", None, TS2),
            ("t2", 77, 1, 8, later, "PASS", 11, TS2),
            ("t3", 1, 2, 7, at, "PASS", 0, TS2),  # no such schedule
            ("t1", 2, 1, 5, at, "PASS", 0, TS2),  # no such operator
            ("t9", 2, 1, 7, at, "PASS", 0, TS2),  # never activated
        )
    )
    return activations, movements, tocs, places, trains


def test_staging_folds_movements_at_one_place_and_instant(spark, facts):
    movements = facts[1]
    kept = movements.filter("train_id = 't1' and loc_stanox = 1")
    assert rows(kept.select("event_type", "timetable_variation")) == [("ARRIVAL", -1)]


def test_fact_movement_fans_out_over_places(facts):
    activations, movements, tocs, places, trains = facts
    fact = core.fact_movement(movements, activations, trains, places, tocs, RUN)
    # station 1 has two places: as current place of t1, and as next place of t2
    assert rows(fact.groupBy("train_id", "loc_stanox").count()) == [("t1", 1, 2), ("t1", 2, 1), ("t2", 77, 2)]
    assert {r.location_id for r in fact.filter("train_id = 't2'").collect()} == {UNKNOWN}
    assert {r.next_location_id for r in fact.filter("loc_stanox = 2").collect()} == {UNKNOWN}
    single = core.fact_movement(movements, activations, trains, places, tocs, RUN, dedupe_locations=True)
    assert rows(single.groupBy("train_id", "loc_stanox").count()) == [("t1", 1, 1), ("t1", 2, 1), ("t2", 77, 1)]


def test_fact_activation(facts):
    activations, _, tocs, _, trains = facts
    fact = core.fact_activation(activations, trains, tocs, RUN)
    assert rows(fact.select("train_id")) == [("t1",), ("t2",)]
    assert fact.filter("schedule_id is null or toc_id is null").count() == 0


def test_status_routes_and_delays(spark, facts, schedules):
    activations, movements, tocs, places, trains = facts
    fact = core.fact_movement(movements, activations, trains, places, tocs, RUN)
    status = marts.train_status(fact)
    assert rows(status.select("train_id", "event_type").distinct()) == [("t1", "ARRIVAL"), ("t2", "PASS")]
    stops = core.fact_scheduled_location(intermediate.schedule_stops(schedules), places, trains)
    assert stops.count() == 3 and stops.filter(F.col("location_id") == UNKNOWN).count() == 1
    routes = marts.route_start_stop(stops, trains, places)
    assert rows(routes.select("train_uid", "route_desc")) == [("U1", "ALPHA-Unknown Location")]
    delays = marts.train_delay(fact, stops, trains, routes, places, tocs)
    assert rows(delays.select("train_id", "location_name", "delay_category", "toc_name")) == [
        ("t1", "ALPHA", "on_time", "One"), ("t1", "BETA REF", "major_delay", "One")
    ]
    board = marts.live_train(status, stops, trains, places, dt.datetime(2024, 1, 10, 10, 45))
    assert rows(board.select("train_id", "location_name", "scheduled_event_timestamp")) == [
        ("t1", "BETA REF", dt.datetime(2024, 1, 10, 10, 0))
    ]
    assert marts.live_train(status, stops, trains, places, dt.datetime(2024, 1, 10, 11, 1)).count() == 0


def test_station_performance_counts_and_worst_events(facts):
    activations, movements, tocs, places, trains = facts
    fact = core.fact_movement(movements, activations, trains, places, tocs, RUN)
    perf = performance.station_performance(fact, places, tocs)
    unknown = perf.filter("location_name = 'Unknown Location'")
    assert rows(unknown.select("total_events", "major_delay_events", "sum_delay_mins", "toc", "delay")) == [
        (2, 2, 22, "Two", 11), (2, 2, 22, "Two", 11)
    ]
    beta = perf.filter("location_name = 'BETA REF'").first()
    assert (beta.total_events, beta.sum_delay_mins, beta.avg_delay_mins, beta.service_date) == (1, None, None, None)
    assert beta.on_time_events + beta.slight_delay_events + beta.delay_events + beta.major_delay_events == 0


def test_worst_events_stop_at_five(spark):
    fact = spark.range(40).select(
        F.lit("L").alias("location_id"), F.lit("T").alias("toc_id"), F.lit(TS1).alias("actual_timestamp"),
        F.lit(TS1).alias("planned_timestamp"), F.lit("PASS").alias("event_type"), F.lit(3).cast("bigint").alias("timetable_variation"),
    )
    places = spark.createDataFrame([("L", 1, "A")], "location_id string, station_id bigint, location_name string")
    tocs = spark.createDataFrame([("T", "One")], "toc_id string, toc_name string")
    perf = performance.station_performance(fact, places, tocs)
    assert rows(perf.select("total_events", "toc", "delay")) == [(40, "One", 3)] * 5


def test_timetable_queries(spark, schedules, trains, places):
    geo = places.select("location_id", "location_name").withColumns({"latitude": F.lit(50.0), "longitude": F.lit(1.0)})
    stops = core.fact_scheduled_location(intermediate.schedule_stops(schedules), places, trains)
    tocs = spark.createDataFrame([("One", "AA")], "toc_name string, toc_schedule_code string")
    day = dt.date(2024, 1, 10)
    assert rows(timetable.train_uids_on(trains, day).select("train_uid")) == [("U1",), ("U2",), ("U3",)]
    assert timetable.train_uids_on(trains, dt.date(2024, 1, 13)).count() == 0  # a Saturday
    found = timetable.route_stops(stops, trains, geo, tocs, day, train_uid="U1")
    meta = timetable.route_meta(found).collect()
    assert len(meta) == 1 and meta[0].stops == ["ALPHA", "BETA REF", "Unknown Location"]
    assert meta[0].tt_dep_pub == ["09:30:00", "--", "--"] and meta[0].platforms == ["2", "--", "--"]
    assert timetable.route_meta(found, station="GAMMA").count() == 0
    table = timetable.timetable_rows(timetable.route_meta(found, station="BETA REF"))
    assert rows(table.select("stop_no", "station", "pass_timetable"))[1] == (1, "BETA REF", "10:00:00")
    at = dt.datetime(2024, 1, 10, 9, 0)
    # passing time counts, unless the strict form is asked for
    hit = timetable.station_search(found, "BETA REF", at, 60)
    assert rows(hit) == [("U1", "--", "ALPHA", "Unknown Location", dt.datetime(2024, 1, 10, 10))]
    assert timetable.station_search(found, "BETA REF", at, 59).count() == 0
    assert timetable.station_search(found, "BETA REF", at, 60, strict=True).count() == 0
    assert timetable.station_search(found, "ALPHA", at, 30, strict=True).count() == 1


def test_associations(spark):
    payload = {
        "main_train_uid": "U1", "assoc_train_uid": "U2", "assoc_start_date": "2024-01-01T00:00:00Z",
        "assoc_end_date": "2024-01-31T00:00:00Z", "assoc_days": "0010000", "category": "VV", "date_indicator": "N",
        "location": "AAA", "CIF_stp_indicator": "P",
    }
    staged = staging.association(raw(spark, ("JsonAssociationV1", payload, TS1), ("JsonAssociationV1", payload, TS2)))
    dim = core.dim_train_association(staged)
    assert rows(timetable.associations_on(dim, dt.date(2024, 1, 10), "U1")) == [("U2", "Divide", "AAA")]
    assert timetable.associations_on(dim, dt.date(2024, 1, 11)).count() == 0
    assert timetable.associations_on(dim, dt.date(2024, 1, 10), "U2").count() == 0


def test_bridge_and_berth_events(spark, trains):
    describer = staging.describer(
        spark.createDataFrame(
            [("CA", "SK", TS2, "1", None, " 1A23 ", TS2), ("CT", "SK", TS2, None, None, "", TS2), ("CA", "ZZ", TS2, "1", "2", "9X99", TS2)],
            "msg_type string, area_id string, event_ts timestamp, from_berth string, to_berth string, descr string, ingest_ts timestamp",
        ).withColumn("report_time", F.lit(None).cast("string"))
    )
    bridge = core.bridge_td_to_schedule(describer, trains)
    assert rows(bridge.groupBy("train_signalling_id").count()) == sorted([("1A23", 3), ("9X99", 1), (None, 1)], key=repr)
    areas = spark.createDataFrame([("k", "SK")], "td_area_id string, area_id string")
    berths = spark.createDataFrame([("b", "SK", "1", "2")], "signal_berth_id string, area_id string, from_berth string, to_berth string")
    events = core.fact_berth_events(describer, areas, berths, bridge)
    assert rows(events.select("train_uid", "td_area_id", "signal_berth_id")) == [(u, "k", UNKNOWN) for u in ("U1", "U2", "U3")]


def test_combined_board_prefers_live_rows(spark):
    states = spark.createDataFrame([("t1", "LIVE")], "train_id string, location_name string").withColumns(
        {c: F.lit(None).cast("string") for c in live.BOARD if c not in ("train_id", "location_name")}
    )
    snapshot = states.withColumn("location_name", F.lit("SNAP")).unionByName(states.withColumn("train_id", F.lit("t2")))
    board = live.combined_board(live.live_board(states), live.live_board(snapshot))
    assert rows(board.select("Train ID", "Current Station")) == [("t1", "LIVE"), ("t2", "LIVE")]
