"""Explicit schemas of all inputs; nothing is inferred."""

from __future__ import annotations

SCHEDULE_PAYLOAD = """
    CIF_train_uid string, transaction_type string, schedule_start_date string, schedule_end_date string,
    schedule_days_runs string, CIF_bank_holiday_running string, train_status string, CIF_stp_indicator string,
    atoc_code string, applicable_timetable string, schedule_segment string
"""

SCHEDULE_SEGMENT = """
    signalling_id string, CIF_train_category string, CIF_headcode string, CIF_train_service_code string,
    CIF_operating_characteristics string, CIF_power_type string, CIF_speed string, CIF_train_class string,
    CIF_reservations string, schedule_location string
"""

SCHEDULE_LOCATION = """
    record_identity string, tiploc_code string, tiploc_instance string, arrival string, departure string,
    public_arrival string, public_departure string, pass string, platform string, line string, path string,
    engineering_allowance string, pathing_allowance string, performance_allowance string
"""

ASSOCIATION_PAYLOAD = """
    transaction_type string, main_train_uid string, assoc_train_uid string, assoc_start_date string,
    assoc_end_date string, assoc_days string, category string, date_indicator string, location string,
    base_location_suffix string, assoc_location_suffix string, diagram_type string, CIF_stp_indicator string
"""

TIPLOC_PAYLOAD = """
    transaction_type string, tiploc_code string, nalco string, stanox string, crs_code string,
    description string, tps_description string
"""

# Seed files
SEEDS = {
    "toc": "company string, business_code string, sector_code string, atoc_code string",
    "td_area": (
        "area_id string, name string, sig boolean, rte boolean, lat boolean, trk boolean, pts boolean,"
        " lxg boolean, Notes string"
    ),
    "train_category": "Code string, Category string, Description string",
    "stanox": "stanox_code string, br_region string, locations string",
    "trust_corpus": (
        "nlc bigint, stanox bigint, tiploc string, three_alpha string, uic string, nlc_desc string, nlc_desc_16 string"
    ),
    "td_smart": (
        "step_type string, from_berth string, to_berth string, stanox string, event string, platform string,"
        " to_line string, berth_offset string, route string, from_line string, td string, comment string,"
        " stanme string"
    ),
    "stops": (
        "ATCOCode string, CommonName string, Street string, Indicator string, Bearing string, LocalityName string,"
        " ParentLocalityName string, GridType string, Easting bigint, Northing bigint, Longitude double,"
        " Latitude double, StopType string, CreationDateTime timestamp, ModificationDateTime timestamp, Status string"
    ),
}

# Reference extracts: JSON name -> our name
CORPUS_FIELDS = {
    "NLC": "nlc",
    "STANOX": "stanox",
    "TIPLOC": "tiploc",
    "3ALPHA": "three_alpha",
    "UIC": "uic",
    "NLCDESC": "nlc_desc",
    "NLCDESC16": "nlc_desc_16",
}
BERTH_STEP_FIELDS = {
    "STEPTYPE": "step_type",
    "FROMBERTH": "from_berth",
    "TOBERTH": "to_berth",
    "STANOX": "stanox",
    "EVENT": "event",
    "PLATFORM": "platform",
    "TOLINE": "to_line",
    "BERTHOFFSET": "berth_offset",
    "ROUTE": "route",
    "FROMLINE": "from_line",
    "TD": "td",
    "COMMENT": "comment",
    "STANME": "stanme",
}
AREA_FIELDS = {
    "ID": "area_id",
    "Name": "name",
    "SIG": "sig",
    "RTE": "rte",
    "LAT": "lat",
    "TRK": "trk",
    "PTS": "pts",
    "LXG": "lxg",
    "Commissioning": "commissioning",
}
AREA_TICKS = ("sig", "rte", "lat", "trk", "pts", "lxg")
STANOX_FIELDS = {"STANOX Code": "stanox_code", "BR Region": "br_region", "Main Locations": "locations"}
STOP_COLUMNS = (
    "ATCOCode", "CommonName", "Street", "Indicator", "Bearing", "LocalityName", "ParentLocalityName", "GridType",
    "Easting", "Northing", "Longitude", "Latitude", "StopType", "CreationDateTime", "ModificationDateTime", "Status",
)

# Live state of one train
TRAIL_POINT = "struct<longitude:double,latitude:double>"

# The fields of each typed event and how their text is read. Fields come from the
# message body unless listed as header fields.
TEXT, INTEGER, MILLIS, BOOLEAN, DAY = "text", "integer", "epoch milliseconds", "boolean", "date at midnight"
TYPED_EVENTS = {
    "activation": {
        "train_id": TEXT,
        "train_uid": TEXT,
        "train_service_code": TEXT,
        "train_file_address": TEXT,
        "schedule_type": TEXT,
        "schedule_source": TEXT,
        "schedule_start_date": TEXT,
        "schedule_end_date": TEXT,
        "schedule_wtt_id": TEXT,
        "sched_origin_stanox": INTEGER,
        "tp_origin_stanox": INTEGER,
        "tp_origin_timestamp": DAY,
        "origin_dep_timestamp": MILLIS,
        "creation_timestamp": MILLIS,
        "train_call_type": TEXT,
        "train_call_mode": TEXT,
        "toc_id": INTEGER,
        "d1266_record_number": TEXT,
        "source_dev_id": TEXT,
        "user_id": TEXT,
        "original_data_source": TEXT,
        "source_system_id": TEXT,
        "msg_queue_timestamp": MILLIS,
    },
    "cancellation": {
        "train_id": TEXT,
        "train_service_code": TEXT,
        "train_file_address": TEXT,
        "canx_type": TEXT,
        "canx_reason_code": TEXT,
        "canx_timestamp": MILLIS,
        "orig_loc_stanox": INTEGER,
        "orig_loc_timestamp": MILLIS,
        "dep_timestamp": MILLIS,
        "loc_stanox": INTEGER,
        "toc_id": INTEGER,
        "division_code": TEXT,
    },
    "movement": {
        "train_id": TEXT,
        "train_service_code": TEXT,
        "division_code": TEXT,
        "toc_id": INTEGER,
        "route": TEXT,
        "loc_stanox": INTEGER,
        "next_report_stanox": INTEGER,
        "reporting_stanox": INTEGER,
        "platform": TEXT,
        "actual_timestamp": MILLIS,
        "planned_timestamp": MILLIS,
        "planned_event_type": TEXT,
        "event_type": TEXT,
        "timetable_variation": INTEGER,
        "variation_status": TEXT,
        "next_report_run_time": INTEGER,
        "correction_ind": BOOLEAN,
        "offroute_ind": BOOLEAN,
        "train_terminated": BOOLEAN,
        "delay_monitoring_point": BOOLEAN,
        "auto_expected": BOOLEAN,
        "event_source": TEXT,
    },
    "reinstatement": {
        "train_id": TEXT,
        "current_train_id": TEXT,
        "reinstatement_timestamp": MILLIS,
        "dep_timestamp": MILLIS,
        "loc_stanox": INTEGER,
        "original_loc_stanox": INTEGER,
        "original_loc_timestamp": MILLIS,
        "toc_id": INTEGER,
        "division_code": TEXT,
        "train_service_code": TEXT,
        "train_file_address": TEXT,
    },
    "change_origin": {
        "train_id": TEXT,
        "current_train_id": TEXT,
        "coo_timestamp": MILLIS,
        "reason_code": TEXT,
        "dep_timestamp": MILLIS,
        "loc_stanox": INTEGER,
        "original_loc_stanox": INTEGER,
        "original_loc_timestamp": MILLIS,
        "toc_id": INTEGER,
        "division_code": TEXT,
        "train_service_code": TEXT,
        "train_file_address": TEXT,
    },
    "change_identity": {
        "train_id": TEXT,
        "current_train_id": TEXT,
        "revised_train_id": TEXT,
        "event_timestamp": MILLIS,
        "train_service_code": TEXT,
        "train_file_address": TEXT,
    },
    "change_location": {
        "train_id": TEXT,
        "current_train_id": TEXT,
        "event_timestamp": MILLIS,
        "loc_stanox": INTEGER,
        "dep_timestamp": MILLIS,
        "original_loc_stanox": INTEGER,
        "original_loc_timestamp": MILLIS,
        "train_service_code": TEXT,
        "train_file_address": TEXT,
    },
}
HEADER_FIELDS = {"source_dev_id", "user_id", "original_data_source", "source_system_id", "msg_queue_timestamp"}
MESSAGE_TYPES = {
    "0001": "activation",
    "0002": "cancellation",
    "0003": "movement",
    "0005": "reinstatement",
    "0006": "change_origin",
    "0007": "change_identity",
    "0008": "change_location",
}


def _message_schema() -> str:
    """Raw feed message: every field any event type reads, as text."""
    names = dict.fromkeys(name for fields in TYPED_EVENTS.values() for name in fields)
    header = ", ".join(f"{n}: string" for n in ["msg_type", *[n for n in names if n in HEADER_FIELDS]])
    body = ", ".join(f"{n}: string" for n in names if n not in HEADER_FIELDS)
    return f"header struct<{header}>, body struct<{body}>"


MESSAGE = _message_schema()
