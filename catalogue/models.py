"""The model chain over rail-shaped inputs made of the test tables.

Inputs are raw JSON built row by row, so every model runs its real parsing.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railmill.operators.arrays import computed_once
from railmill.plans import core, intermediate, staging
from railmill.sources.feeds import parse_messages, split_berth_frames, split_frames, typed_berth_steps, typed_events
from railmill.sources.files import spread, tagged_records

RUN_TS = dt.datetime(2024, 2, 2, 2, 0, 0)

SCHEDULE_JSON = """
    select 'JsonScheduleV1' as record_type, ingest_ts, to_json(named_struct(
        'CIF_train_uid', train_uid, 'transaction_type', 'Create', 'schedule_start_date', cast(start_date as string),
        'schedule_end_date', cast(end_date as string), 'schedule_days_runs', day_mask,
        'CIF_bank_holiday_running', holiday_code, 'train_status', status_code, 'CIF_stp_indicator', stp,
        'atoc_code', atoc_code, 'applicable_timetable', timetable,
        'schedule_segment', named_struct(
            'signalling_id', signalling_id, 'CIF_train_category', category_code, 'CIF_headcode', '0000',
            'CIF_train_service_code', service_code, 'CIF_operating_characteristics', operating_code,
            'CIF_power_type', power_code, 'CIF_speed', speed, 'CIF_train_class', 'B', 'CIF_reservations', reservation_code,
            'schedule_location', case when k % 37 <> 0 then transform(sequence(0, cast(1 + k % 3 as int)), i -> named_struct(
                'record_identity', case when i = 0 then 'LO' when i = 1 + k % 3 then 'LT' else 'LI' end,
                'tiploc_code', 'TIP' || cast((k + 13 * i) % 1000 as string),
                'tiploc_instance', case when i = 2 then '2' when i = 3 then 'x' end,
                'arrival', case when i > 0 then lpad(cast(6 + 4 * i + k % 3 as string), 2, '0') || lpad(cast(k % 60 as string), 2, '0') || case when k % 4 = 0 then 'H' else '' end end,
                'departure', case when i < 1 + k % 3 then lpad(cast(6 + 4 * i + k % 3 as string), 2, '0') || lpad(cast(k % 70 as string), 2, '0') end,
                'public_arrival', case when i > 0 and k % 2 = 0 then lpad(cast(6 + 4 * i + k % 3 as string), 2, '0') || '30' else '' end,
                'public_departure', case when i = 0 then '0' || cast(6 + k % 3 as string) || '15' end,
                'pass', case when k % 5 = 0 then '2400' end,
                'platform', case when k % 12 > 0 then cast(k % 12 as string) end,
                'line', 'FL', 'path', cast(null as string),
                'engineering_allowance', case k % 6 when 0 then 'H' when 1 then '1' when 2 then '2H' when 3 then '12' when 4 then '1X' else '' end,
                'pathing_allowance', 'H')) end))) as payload
    from {in_schedule}
"""

ASSOCIATION_JSON = """
    select 'JsonAssociationV1' as record_type, ingest_ts, to_json(named_struct(
        'transaction_type', 'Create', 'main_train_uid', main_uid, 'assoc_train_uid', assoc_uid,
        'assoc_start_date', cast(start_date as string) || 'T00:00:00Z', 'assoc_end_date', cast(end_date as string) || 'T00:00:00Z',
        'assoc_days', day_mask, 'category', category, 'date_indicator', date_indicator, 'location', location,
        'diagram_type', 'T', 'CIF_stp_indicator', stp)) as payload
    from {in_association}
"""

TIPLOC_JSON = """
    select 'TiplocV1' as record_type, ingest_ts, to_json(named_struct(
        'transaction_type', 'Create', 'tiploc_code', tiploc_code, 'nalco', cast(nalco as string), 'stanox', cast(stanox as string),
        'crs_code', crs_code, 'description', description)) as payload
    from {in_tiploc}
"""

MOVEMENT_JSON = """
    select ingest_ts, to_json(named_struct(
        'header', named_struct('msg_type', '0003', 'source_dev_id', 'dev'),
        'body', named_struct(
            'train_id', train_id, 'toc_id', cast(toc_id as string), 'loc_stanox', lpad(cast(loc_stanox as string), 5, '0'),
            'next_report_stanox', cast(next_report_stanox as string), 'actual_timestamp', cast(unix_millis(cast(actual_timestamp as timestamp)) as string),
            'planned_timestamp', '', 'event_type', event_type, 'timetable_variation', cast(timetable_variation as string),
            'variation_status', variation_status, 'platform', platform,
            'train_terminated', case when train_terminated then 'TRUE' else 'false' end))) as value
    from {in_movement}
"""

ACTIVATION_JSON = """
    select ingest_ts, '[' || to_json(named_struct(
        'header', named_struct('msg_type', '0001', 'user_id', 'u1', 'msg_queue_timestamp', '1706745600000'),
        'body', named_struct(
            'train_id', train_id, 'train_uid', train_uid, 'schedule_type', schedule_type, 'schedule_source', schedule_source,
            'schedule_start_date', schedule_start_date, 'schedule_end_date', schedule_end_date, 'toc_id', cast(toc_id as string),
            'tp_origin_timestamp', schedule_start_date, 'tp_origin_stanox', cast(tp_origin_stanox as string),
            'origin_dep_timestamp', cast(unix_millis(cast(origin_dep_timestamp as timestamp)) as string),
            'creation_timestamp', cast(unix_millis(cast(creation_timestamp as timestamp)) as string)))) || ']' as value
    from {in_activation}
"""

BERTH_JSON = """
    select event_ts as ingest_ts, '[{{"SF_MSG":{{"x":"1"}}}},{{"' || msg_type || '_MSG":' || to_json(named_struct(
        'time', cast(unix_millis(cast(event_ts as timestamp)) as string), 'area_id', area_id, 'msg_type', msg_type,
        'from', from_berth, 'to', to_berth, 'descr', descr, 'report_time', report_time)) || '}}]' as value
    from {in_describer}
"""


class Models:
    def __init__(self, tables):
        self.tables = tables
        self.spark = tables.spark

    def _sql(self, text: str, role: str) -> DataFrame:
        # the small test files feed one task each; building and parsing JSON needs all cores
        made = self.spark.sql(text, **{role: spread(self.tables.role(role))})
        name = "value" if "value" in made.columns else "payload"
        once = computed_once(made.withColumnRenamed(name, "_json"), name, F.col("_json"))
        return once.select(*made.columns)

    # ---- raw inputs ---------------------------------------------------------------
    @cached_property
    def raw_dump(self) -> DataFrame:
        parts = [
            self._sql(SCHEDULE_JSON, "in_schedule"),
            self._sql(ASSOCIATION_JSON, "in_association"),
            self._sql(TIPLOC_JSON, "in_tiploc"),
        ]
        rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
        return rows.select("record_type", "payload", F.col("ingest_ts").cast("timestamp").alias("ingest_ts"))

    @cached_property
    def dump_lines(self) -> DataFrame:
        """The raw dump as tagged JSON lines."""
        line = F.concat(F.lit('{"'), F.col("record_type"), F.lit('":'), F.col("payload"), F.lit("}"))
        return self.raw_dump.select(line.alias("value"), "ingest_ts")

    def landed(self, lines: DataFrame) -> DataFrame:
        return tagged_records(lines, F.lit(RUN_TS))

    @cached_property
    def movement_frames(self) -> DataFrame:
        return self._sql(MOVEMENT_JSON, "in_movement")

    @cached_property
    def activation_frames(self) -> DataFrame:
        return self._sql(ACTIVATION_JSON, "in_activation")

    @cached_property
    def berth_frames(self) -> DataFrame:
        return self._sql(BERTH_JSON, "in_describer")

    @cached_property
    def movement_clean(self) -> DataFrame:
        return typed_events(parse_messages(split_frames(self.movement_frames)), "movement")

    @cached_property
    def activation_clean(self) -> DataFrame:
        return typed_events(parse_messages(split_frames(self.activation_frames)), "activation")

    @cached_property
    def describer_clean(self) -> DataFrame:
        return typed_berth_steps(split_berth_frames(self.berth_frames))

    # ---- seeds ---------------------------------------------------------------------
    @cached_property
    def toc_seed(self) -> DataFrame:
        return self.tables.role("in_toc")

    @cached_property
    def area_seed(self) -> DataFrame:
        return self.tables.role("in_area")

    @cached_property
    def corpus_seed(self) -> DataFrame:
        return self.tables.role("in_corpus")

    @cached_property
    def smart_seed(self) -> DataFrame:
        return self.tables.role("in_smart")

    @cached_property
    def stops_seed(self) -> DataFrame:
        names = {"atcocode": "ATCOCode", "latitude": "Latitude", "longitude": "Longitude", "easting": "Easting",
                 "northing": "Northing", "stoptype": "StopType"}
        return self.tables.role("in_stops").withColumnsRenamed(names)

    @cached_property
    def category_seed(self) -> DataFrame:
        names = {"code": "Code", "category": "Category", "description": "Description"}
        return self.tables.role("in_category").withColumnsRenamed(names)

    # ---- staging ----------------------------------------------------------------------
    @cached_property
    def stg_activation(self) -> DataFrame:
        return staging.activation(self.activation_clean)

    @cached_property
    def stg_movement(self) -> DataFrame:
        return staging.movement(self.movement_clean)

    @cached_property
    def stg_describer(self) -> DataFrame:
        return staging.describer(self.describer_clean)

    @cached_property
    def stg_schedule(self) -> DataFrame:
        return staging.schedule(self.raw_dump)

    @cached_property
    def stg_association(self) -> DataFrame:
        return staging.association(self.raw_dump)

    @cached_property
    def stg_tiploc(self) -> DataFrame:
        return staging.tiploc(self.raw_dump)

    # ---- intermediate -------------------------------------------------------------------
    @cached_property
    def headers(self) -> DataFrame:
        return intermediate.schedule_headers(self.stg_schedule)

    @cached_property
    def stops(self) -> DataFrame:
        return intermediate.schedule_stops(self.stg_schedule)

    # ---- core -----------------------------------------------------------------------------
    @cached_property
    def dim_location(self) -> DataFrame:
        return core.dim_location(
            intermediate.scheduled_places(self.stg_tiploc), intermediate.reference_places(self.corpus_seed), RUN_TS
        )

    @cached_property
    def dim_geo(self) -> DataFrame:
        return core.dim_geo(self.dim_location, self.stops_seed, RUN_TS)

    @cached_property
    def dim_toc(self) -> DataFrame:
        return core.dim_toc(intermediate.operators(self.toc_seed), RUN_TS)

    @cached_property
    def dim_area(self) -> DataFrame:
        return core.dim_area(self.area_seed, RUN_TS)

    @cached_property
    def dim_signal_berth(self) -> DataFrame:
        return core.dim_signal_berth(self.smart_seed, RUN_TS)

    @cached_property
    def dim_train_schedule(self) -> DataFrame:
        return core.dim_train_schedule(self.headers, self.category_seed, RUN_TS)

    @cached_property
    def bridge_td(self) -> DataFrame:
        return core.bridge_td_to_schedule(self.stg_describer, self.dim_train_schedule)
