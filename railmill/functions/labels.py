"""Code labels, topic names, seed column names and sentinels.

Everything in this file must equal the published code lists and table contracts,
otherwise results would differ.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- code -> label ---------------------------------------------------------------
ASSOCIATION_DATE = {
    "S": "Standard - the association occurs on the same day",
    "N": "Over next-midnight - the association occurs the next day",
    "P": "Over previous-midnight - the association occurs the previous day",
}
ASSOCIATION_TYPE = {"JJ": "Join", "NP": "Next", "VV": "Divide"}
BANK_HOLIDAY = {
    "X": "Does not run on specified Bank Holiday Mondays",
    "G": "Does not run on Glasgow Bank Holidays",
}
OPERATING_CHARACTERISTIC = {
    "B": "Vacuum Braked",
    "C": "Timed at 100 m.p.h.",
    "D": "DOO (Coaching stock trains)",
    "E": "Conveys Mark 4 Coaches",
    "G": "Trainman (Guard) required",
    "M": "Timed at 110 m.p.h.",
    "P": "Push/Pull train",
    "Q": "Runs as required",
    "R": "Air conditioned with PA system",
    "S": "Steam Heated",
    "Y": "Runs to Terminals/Yards as required",
    "Z": "May convey traffic to SB1C gauge. Not to be diverted from booked route without authority.",
}
POWER_TYPE = {
    "D": "Diesel",
    "DEM": "Diesel Electric Multiple Unit",
    "DMU": "Diesel Mechanical Multiple Unit",
    "E": "Electric",
    "ED": "Electro-Diesel",
    "EML": "EMU plus D, E, ED locomotive",
    "EMU": "Electric Multiple Unit",
    "HST": "High Speed Train",
}
RESERVATIONS = {
    "A": "Reservations compulsory",
    "E": "Reservations for bicycles essential",
    "R": "Reservations recommended",
    "S": "Reservations possible from any station",
}
STP_INDICATOR = {
    "C": "STP cancellation of permanent schedule",
    "N": "New STP schedule (not an overlay)",
    "O": "STP overlay of permanent schedule",
    "P": "Permanent",
}
TRAIN_STATUS = {
    "B": "Bus (Permanent)",
    "F": "Freight (Permanent - WTT)",
    "P": "Passenger & Parcels (Permanent - WTT)",
    "S": "Ship (Permanent)",
    "T": "Trip (Permanent)",
    "1": "STP Passenger & Parcels",
    "2": "STP Freight",
    "3": "STP Trip",
    "4": "STP Ship",
    "5": "STP Bus",
}
TRAIN_CLASS = {"B": "First and Standard", "S": "Standard Only"}
LOCATION_TYPE = {  # the leading blank of the first label is part of the value
    "LO": " Originating location - location where the train service starts from",
    "LI": "Intermediate location",
    "LT": "Terminating location - where the service terminates",
}

# --- message type -> topic ---------------------------------------------------------
TOPICS = {
    "0001": "rail_activation_clean",
    "0002": "rail_cancellation_clean",
    "0003": "rail_movement_clean",
    "0005": "rail_reinstatement_clean",
    "0006": "rail_change_origin_clean",
    "0007": "rail_change_identity_clean",
    "0008": "rail_change_location_clean",
}
DEAD_LETTER_TOPIC = "rail_movement_dlq"
BERTH_TOPIC = "rail_td_mov_clean"

# --- delay buckets ------------------------------------------------------------------
DELAY_BUCKETS = ("on_time", "slight_delay", "delay", "major_delay")

# --- weekday flag columns, Monday first ---------------------------------------------
DAY_FLAGS = (
    "mon_service",
    "tue_service",
    "wednes_service",
    "thrus_service",
    "fri_service",
    "sat_service",
    "sun_service",
)

# --- sentinels ------------------------------------------------------------------------
KEY_NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
UNKNOWN_MEMBER = "Unknown"
MISSING_TEXT = "--"
LIVE_TRAIL_POINTS = 20
LIVE_STALE_MINUTES = 5
PARQUET_ROWS_PER_FILE = 100_000

# --- train category name fragment -> display colour (first match wins) --------------------
CATEGORY_COLOURS = {
    "Express Passenger": (255, 0, 0),
    "Ordinary Passenger": (255, 140, 0),
    "Unadvertised Ordinary Passenger": (255, 215, 0),
    "Staff Train": (255, 215, 0),
    "London Underground/Metro Service": (255, 215, 0),
    "ECS": (128, 0, 128),
    "Empty Coaching Stock": (128, 0, 128),
    "Freight": (0, 100, 255),
    "Postal": (0, 100, 255),
    "Departmental": (0, 100, 255),
    "Light Locomotive": (160, 160, 160),
    "Bus": (0, 180, 0),
    "Ship": (0, 180, 0),
}
DEFAULT_COLOUR = (200, 200, 200)


def code_label(col: Column, labels: dict[str, str], default: str | None = None) -> Column:
    """Label of a code; codes outside the list (and null) give ``default``."""
    pairs = [F.lit(x) for pair in labels.items() for x in pair]
    label = F.try_element_at(F.create_map(*pairs), col.cast("string"))
    return label if default is None else F.coalesce(label, F.lit(default))
