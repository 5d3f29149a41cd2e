"""P-01 to P-41: models, marts and the queries over them."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogue.models import RUN_TS
from catalogue.models_sql import DAYS, RUN, UNKNOWN, flags, sk
from catalogue.registry import query
from railmill.operators.dedup import first_k
from railmill.plans import core, intermediate, live, marts, performance, timetable
from railmill.plans.daily import run_daily
from railmill.session import shared_dir

DAY = dt.date(2024, 1, 10)  # a Wednesday
RUNS = "date '2024-01-10' between schedule_start_date and schedule_end_date and wednes_service"


def text(*names: str) -> str:
    """Select items rendering dates and timestamps as text."""
    return ", ".join(f"cast({n} as varchar) as {n.split('.')[-1]}" for n in names)


# ---- staging ------------------------------------------------------------------------------


@query(
    "p01_stg_activation",
    f"""select activation_id, {text("ingest_ts")}, train_id, train_uid, schedule_type, schedule_source,
        schedule_start_date, schedule_end_date, cast(tp_origin_stanox as bigint) as tp_origin_stanox,
        schedule_start_date || ' 00:00:00' as tp_origin_timestamp, {text("origin_dep_timestamp", "creation_timestamp")},
        cast(toc_id as bigint) as toc_id, 'u1' as user_id, '2024-02-01 00:00:00' as msg_queue_timestamp from stg_activation""",
    ("stg_activation",),
)
def _(t):
    return t.models.stg_activation.select(
        "activation_id", "ingest_ts", "train_id", "train_uid", "schedule_type", "schedule_source",
        "schedule_start_date", "schedule_end_date", "tp_origin_stanox", "tp_origin_timestamp",
        "origin_dep_timestamp", "creation_timestamp", "toc_id", "user_id", "msg_queue_timestamp",
    )


@query(
    "p02_stg_describer",
    f"""select describer_id, msg_type, area_id, {text("event_ts", "ingest_ts")}, from_berth, to_berth, train_signalling_id,
        report_time from stg_describer""",
    ("stg_describer",),
)
def _(t):
    return t.models.stg_describer


@query(
    "p03_stg_movement",
    f"""select movement_id, train_id, cast(toc_id as bigint) as toc_id, cast(loc_stanox as bigint) as loc_stanox,
        cast(next_report_stanox as bigint) as next_report_stanox, {text("actual_timestamp")}, event_type, timetable_variation,
        variation_status, platform, train_terminated, {text("ingest_ts")} from stg_movement""",
    ("stg_movement",),
)
def _(t):
    return t.models.stg_movement.select(
        "movement_id", "train_id", "toc_id", "loc_stanox", "next_report_stanox", "actual_timestamp", "event_type",
        "timetable_variation", "variation_status", "platform", "train_terminated", "ingest_ts",
    )


@query(
    "p04_stg_schedule",
    f"""select schedule_id, {text("ingest_ts")}, train_uid, 'Create' as transaction_type,
        cast(start_date as varchar) as schedule_start_date, cast(end_date as varchar) as schedule_end_date,
        day_mask as schedule_days_runs, holiday_code as bank_holiday_code, status_code as train_status, stp as stp_indicator,
        atoc_code, timetable as applicable_timetable, k % 37 <> 0 as has_locations from stg_schedule""",
    ("stg_schedule",),
)
def _(t):
    return t.models.stg_schedule.withColumn("has_locations", F.col("schedule_location_json").isNotNull()).drop(
        "schedule_segment_json", "schedule_location_json"
    )


@query(
    "p05_stg_association",
    f"""select {text("ingest_ts")}, association_id, 'Create' as transaction_type, main_uid as main_train_uid,
        assoc_uid as assoc_train_uid, cast(start_date as varchar) as assoc_start_date, cast(end_date as varchar) as assoc_end_date,
        day_mask as assoc_days, category as assoc_category, date_indicator, location as assoc_location, stp as stp_indicator
        from stg_association""",
    ("stg_association",),
)
def _(t):
    return t.models.stg_association.drop("base_location_suffix", "assoc_location_suffix", "diagram_type")


@query(
    "p06_stg_tiploc",
    f"""select {text("ingest_ts")}, tiploc_code, nalco, stanox, crs_code, description from stg_tiploc""",
    ("stg_tiploc",),
)
def _(t):
    return t.models.stg_tiploc.drop("transaction_type", "tps_description")


# ---- intermediate ----------------------------------------------------------------------------


@query(
    "p07_int_scheduled_places",
    """select stanox as station_id, upper(nullif(trim(tiploc_code), '')) as tiploc_code, nalco as nlc_code,
        upper(nullif(trim(crs_code), '')) as crs_code, upper(nullif(trim(description), '')) as location_name from stg_tiploc""",
    ("stg_tiploc",),
)
def _(t):
    return intermediate.scheduled_places(t.models.stg_tiploc)


@query(
    "p08_int_schedule_header",
    f"""select * replace (cast(schedule_start_date as varchar) as schedule_start_date,
        cast(schedule_end_date as varchar) as schedule_end_date, cast(ingest_ts as varchar) as ingest_ts) from header""",
    ("header",),
)
def _(t):
    return t.models.headers


@query(
    "p09_int_schedule_stops",
    """select * replace (cast(schedule_start_date as varchar) as schedule_start_date,
        cast(schedule_end_date as varchar) as schedule_end_date, cast(tiploc_instance as bigint) as tiploc_instance) from planned_stop""",
    ("planned_stop",),
)
def _(t):
    return t.models.stops


@query("p10_int_operator", "select * from operator", ("operator",))
def _(t):
    return intermediate.operators(t.models.toc_seed)


@query(
    "p11_int_reference_places",
    """select stanox as station_id, upper(nullif(trim(tiploc), '')) as tiploc_code, nlc as nlc_code,
        upper(nullif(trim(three_alpha), '')) as crs_code, upper(nullif(trim(nlc_desc), '')) as location_name from in_corpus""",
    ("in_corpus",),
)
def _(t):
    return intermediate.reference_places(t.models.corpus_seed)


# ---- core ------------------------------------------------------------------------------------


@query("p12_dim_location", "select * from dim_location", ("dim_location",))
def _(t):
    return t.models.dim_location


@query("p13_dim_geo", "select * from dim_geo", ("dim_geo",))
def _(t):
    return t.models.dim_geo.drop("coordinates")


@query("p14_dim_toc", "select * from dim_toc", ("dim_toc",))
def _(t):
    return t.models.dim_toc


@query("p15_dim_area", "select * from dim_area", ("dim_area",))
def _(t):
    return t.models.dim_area


@query("p16_dim_signal_berth", "select * from dim_signal_berth", ("dim_signal_berth",))
def _(t):
    return t.models.dim_signal_berth


@query(
    "p17_dim_train_schedule",
    """select * replace (cast(schedule_start_date as varchar) as schedule_start_date, cast(schedule_end_date as varchar) as schedule_end_date)
        from dim_train_schedule""",
    ("dim_train_schedule",),
)
def _(t):
    return t.models.dim_train_schedule


@query(
    "p18_dim_train_association",
    f"""select association_id, main_uid as main_train_uid, assoc_uid as assoc_train_uid, cast(start_date as varchar) as assoc_start_date,
        cast(end_date as varchar) as assoc_end_date, case category when 'JJ' then 'Join' when 'NP' then 'Next' when 'VV' then 'Divide' end as associated_type,
        case date_indicator when 'S' then 'Standard - the association occurs on the same day'
             when 'N' then 'Over next-midnight - the association occurs the next day'
             when 'P' then 'Over previous-midnight - the association occurs the previous day' end as associated_date_indicator,
        {flags("day_mask")}, location as assoc_location from stg_association""",
    ("stg_association",),
)
def _(t):
    return core.dim_train_association(t.models.stg_association).drop("base_location_suffix", "assoc_location_suffix")


@query(
    "p19_bridge_td_to_schedule",
    """select * replace (cast(schedule_start_date as varchar) as schedule_start_date, cast(schedule_end_date as varchar) as schedule_end_date)
        from bridge_td""",
    ("bridge_td",),
)
def _(t):
    return t.models.bridge_td


@query(
    "p20_bridge_berth_to_location",
    f"""select {sk("signal_berth_id", "location_id")} as signal_location_bridge_id, signal_berth_id, location_id, true as is_active, {RUN} as dbt_updated_at
        from dim_signal_berth b join dim_location l on b.station_id = l.station_id""",
    ("dim_signal_berth", "dim_location"),
)
def _(t):
    return core.bridge_signal_berth_to_location(t.models.dim_signal_berth, t.models.dim_location, RUN_TS)


@query(
    "p21_fact_activation",
    f"""select {sk("schedule_id", "t.toc_id", "train_id", "schedule_start_date", "schedule_end_date")} as activation_id, schedule_id,
        t.toc_id, train_id, cast(tp_origin_stanox as bigint) as tp_origin_stanox, {text("origin_dep_timestamp", "ingest_ts")}, {RUN} as dbt_updated_at
        from scheduled_activation a left join dim_toc t on a.toc_id = t.toc_operating_code""",
    ("scheduled_activation", "dim_toc"),
)
def _(t):
    m = t.models
    return core.fact_activation(m.stg_activation, m.dim_train_schedule, m.dim_toc, RUN_TS).select(
        "activation_id", "schedule_id", "toc_id", "train_id", "tp_origin_stanox", "origin_dep_timestamp", "ingest_ts",
        "dbt_updated_at",
    )


@query(
    "p22_fact_movement",
    f"""select {sk("m.train_id", "a.schedule_id", "l.location_id", "n.location_id", "t.toc_id", "m.actual_timestamp")} as train_movement_id,
        m.train_id, a.schedule_id, coalesce(l.location_id, {UNKNOWN}) as location_id, coalesce(n.location_id, {UNKNOWN}) as next_location_id,
        t.toc_id, {text("m.actual_timestamp")}, m.event_type, m.timetable_variation, m.train_terminated, {text("m.ingest_ts")}
        from stg_movement m join scheduled_activation a on m.train_id = a.train_id
        join dim_toc t on m.toc_id = t.toc_operating_code
        left join dim_location l on m.loc_stanox = l.station_id left join dim_location n on m.next_report_stanox = n.station_id""",
    ("stg_movement", "scheduled_activation", "dim_toc", "dim_location"),
)
def _(t):
    m = t.models
    fact = core.fact_movement(
        m.stg_movement, m.stg_activation, m.dim_train_schedule, m.dim_location, m.dim_toc, RUN_TS
    )
    return fact.select(
        "train_movement_id", "train_id", "schedule_id", "location_id", "next_location_id", "toc_id", "actual_timestamp",
        "event_type", "timetable_variation", "train_terminated", "ingest_ts",
    )


@query(
    "p23_fact_berth_events",
    f"""select {sk("td_area_id", "signal_berth_id", "bridge_id", "event_ts")} as event_id, td_area_id, coalesce(signal_berth_id, {UNKNOWN}) as signal_berth_id,
        bridge_id, t.schedule_id, t.train_uid, s.train_signalling_id, {text("event_ts", "ingest_ts")}, msg_type, report_time
        from stg_describer s left join dim_area a on s.area_id = a.area_id
        left join dim_signal_berth b on s.area_id = b.area_id and s.from_berth = b.from_berth and s.to_berth = b.to_berth
        join bridge_td t on s.train_signalling_id = t.train_signalling_id and cast(event_ts as date) between schedule_start_date and schedule_end_date
        where msg_type <> 'CT' and t.train_uid is not null""",
    ("stg_describer", "dim_area", "dim_signal_berth", "bridge_td"),
)
def _(t):
    m = t.models
    return core.fact_berth_events(m.stg_describer, m.dim_area, m.dim_signal_berth, m.bridge_td)


@query(
    "p24_fact_scheduled_location",
    f"""select {sk("d.schedule_id", "l.location_id", "loc_offset", "location_type_desc", "arrival_working_timetable_time",
                    "departure_working_timetable_time", "departure_public_timetable_time", "arrival_public_timetable_time",
                    "passing_working_timetable_time")} as scheduled_location_id,
        coalesce(d.schedule_id, {UNKNOWN}) as schedule_id, coalesce(l.location_id, {UNKNOWN}) as location_id, loc_offset, location_type_desc,
        arrival_working_timetable_time, departure_working_timetable_time, arrival_public_timetable_time, departure_public_timetable_time,
        passing_working_timetable_time, platform, line, path, engineering_allowance_mins, pathing_allowance_mins, performance_allowance_mins
        from planned_stop s left join (select * from dim_train_schedule where stp_indicator <> 'C') d on s.train_uid = d.train_uid and s.schedule_start_date = d.schedule_start_date
          and s.schedule_end_date = d.schedule_end_date and s.stp_indicator = d.stp_indicator
        left join dim_location l on s.tiploc_code = l.tiploc_code""",
    ("planned_stop", "dim_train_schedule", "dim_location"),
)
def _(t):
    m = t.models
    return core.fact_scheduled_location(m.stops, m.dim_location, m.dim_train_schedule)


# ---- marts -------------------------------------------------------------------------------------

STATUS = """
    status as (select train_id, schedule_id, location_id, next_location_id, toc_id, planned_timestamp, actual_timestamp, event_type,
                      planned_event_type, timetable_variation, variation_status
               from movement qualify actual_timestamp is not null and rank() over (partition by train_id order by actual_timestamp desc nulls last) = 1)
"""
ROUTES = """
    ends as (select schedule_id, arg_min(location_id, o) as a, arg_max(location_id, o) as z
             from (select schedule_id, location_id, row_number() over (partition by schedule_id order by loc_offset, location_id) as o from stop)
             group by schedule_id),
    all_routes as (select e.schedule_id, s.train_uid, l.location_name as origin, n.location_name as terminating, l.location_name || '-' || n.location_name as route_desc
               from ends e left join schedule s on e.schedule_id = s.schedule_id left join location l on e.a = l.location_id
               left join location n on e.z = n.location_id where e.a <> e.z),
    routes as (select * from all_routes qualify row_number() over (partition by train_uid order by schedule_id) = 1)
"""
AS_OF = dt.datetime(1999, 3, 5, 12, 0, 0)


@query(
    "p25_train_status",
    f"with {STATUS} select * replace (cast(planned_timestamp as varchar) as planned_timestamp, cast(actual_timestamp as varchar) as actual_timestamp) from status",
    ("movement",),
)
def _(t):
    return marts.train_status(t.role("movement")).orderBy(F.desc("actual_timestamp"), "train_id")


@query(
    "p26_live_train",
    f"""with {STATUS}, merged as (
        select m.train_id, m.toc_id, d.train_uid, d.train_signalling_id, l.location_name, l.crs_code, m.event_type, m.planned_event_type,
               m.actual_timestamp, m.planned_timestamp, m.timetable_variation, m.variation_status,
               cast(cast(m.actual_timestamp as date) as varchar) || ' ' || coalesce(s.arrival_public_timetable_time, s.departure_public_timetable_time, s.passing_working_timetable_time) as scheduled_event_timestamp,
               s.arrival_public_timetable_time, s.arrival_working_timetable_time, s.departure_public_timetable_time,
               s.departure_working_timetable_time, s.passing_working_timetable_time, s.platform, s.line
        from stop s join status m on m.schedule_id = s.schedule_id and m.location_id = s.location_id
        left join schedule d on m.schedule_id = d.schedule_id left join location l on m.location_id = l.location_id
        qualify row_number() over (partition by m.train_id order by m.actual_timestamp desc, scheduled_event_timestamp desc nulls last,
            m.event_type desc, m.planned_event_type desc, m.planned_timestamp desc, m.timetable_variation desc nulls last, m.variation_status desc,
            s.arrival_public_timetable_time desc nulls last, s.departure_public_timetable_time desc nulls last, s.passing_working_timetable_time desc nulls last, s.platform desc nulls last, s.line desc) = 1)
        select * replace (cast(actual_timestamp as varchar) as actual_timestamp, cast(planned_timestamp as varchar) as planned_timestamp) from merged
        where scheduled_event_timestamp between '1999-01-04 12:00:00' and '1999-05-04 12:00:00'""",
    ("movement", "stop", "schedule", "location"),
)
def _(t):
    status = marts.train_status(t.role("movement"))
    return marts.live_train(status, t.role("stop"), t.role("schedule"), t.role("location"), AS_OF, dt.timedelta(days=60))


@query("p27_route_start_stop", f"with {ROUTES} select * from routes", ("stop", "schedule", "location"))
def _(t):
    return marts.route_start_stop(t.role("stop"), t.role("schedule"), t.role("location"))


DELAY = """
    delays as (select distinct cast(m.planned_timestamp as date) as service_date, m.actual_timestamp, m.planned_timestamp, t.toc_name, m.train_id,
            d.train_uid, r.route_desc, d.train_signalling_id, d.stp_indicator, d.train_category, l.station_id as location_id, l.location_name,
            n.station_id as next_location_id, n.location_name as next_location_name, s.location_type_desc, m.event_type, m.timetable_variation,
            case when m.timetable_variation <= 0 then 'on_time' when m.timetable_variation <= 5 then 'slight_delay'
                 when m.timetable_variation <= 10 then 'delay' else 'major_delay' end as delay_category, m.next_report_run_time
        from (select distinct schedule_id, location_id, location_type_desc from stop) s
        join movement m on m.schedule_id = s.schedule_id and m.location_id = s.location_id
        left join schedule d on m.schedule_id = d.schedule_id left join routes r on d.train_uid = r.train_uid
        left join location l on m.location_id = l.location_id left join location n on m.next_location_id = n.location_id
        left join toc t on m.toc_id = t.toc_id where m.actual_timestamp is not null)
"""


def delays(t):
    stop, schedule, location = t.role("stop"), t.role("schedule"), t.role("location")
    routes = marts.route_start_stop(stop, schedule, location)
    return marts.train_delay(t.role("movement"), stop, schedule, routes, location, t.role("toc"))


@query(
    "p28_train_delay",
    f"""with {ROUTES}, {DELAY} select * replace (cast(service_date as varchar) as service_date, cast(actual_timestamp as varchar) as actual_timestamp,
        cast(planned_timestamp as varchar) as planned_timestamp) from delays""",
    ("stop", "schedule", "location", "movement", "toc"),
)
def _(t):
    return delays(t)


# ---- timetable ------------------------------------------------------------------------------------


@query(
    "p29_train_uids_on_date",
    f"""select distinct train_uid, coalesce(train_category, 'UNKNOWN') as train_category, coalesce(train_status_desc, 'UNKNOWN') as train_status_desc,
        coalesce(power_type_desc, 'UNKNOWN') as power_type_desc from schedule where {RUNS}""",
    ("schedule",),
)
def _(t):
    return timetable.train_uids_on(t.role("schedule"), DAY)


ROUTE = ", ".join(timetable.ROUTE)
STOP_ROWS = f"""
    rows as (select d.train_uid, d.short_term_planning_schedule_indicator as stp, t.toc_name, d.train_signalling_id, d.train_status_desc, d.train_category,
            d.train_category_desc, d.reservations_desc, d.operating_characteristic_desc, d.planned_speed, d.power_type_desc, s.loc_offset,
            g.location_name, s.location_type_desc, g.longitude, g.latitude, s.arrival_public_timetable_time as arr_pub,
            s.departure_public_timetable_time as dep_pub, s.passing_working_timetable_time as pass_wtt, s.platform
        from stop s join schedule d on s.schedule_id = d.schedule_id join geo g on s.location_id = g.location_id
        left join toc t on d.atoc_code = t.toc_schedule_code
        where g.latitude is not null and g.longitude is not null and {RUNS})
"""


def stop_rows(t, **kwargs):
    return timetable.route_stops(t.role("stop"), t.role("schedule"), t.role("geo"), t.role("toc"), DAY, **kwargs)


ORDERED = "loc_offset, location_name, location_type_desc, longitude, latitude, arr_pub nulls first, dep_pub nulls first, pass_wtt nulls first, platform nulls first"


@query(
    "p30_route_meta",
    f"""with {STOP_ROWS} select {ROUTE}, cast(0 as bigint) as page,
        string_agg(location_name, '|' order by {ORDERED}) as stops, string_agg(location_type_desc, '|' order by {ORDERED}) as stops_type,
        string_agg(longitude || ',' || latitude, '|' order by {ORDERED}) as route_path,
        string_agg(coalesce(arr_pub, '--'), '|' order by {ORDERED}) as tt_arr_pub, string_agg(coalesce(dep_pub, '--'), '|' order by {ORDERED}) as tt_dep_pub,
        string_agg('--', '|') as tt_arr_wtt, string_agg('--', '|') as tt_dep_wtt,
        string_agg(coalesce(pass_wtt, '--'), '|' order by {ORDERED}) as tt_pass_wtt, string_agg(coalesce(platform, '--'), '|' order by {ORDERED}) as platforms
        from rows group by {ROUTE}""",
    ("stop", "schedule", "geo", "toc"),
)
def _(t):
    meta = timetable.route_meta(stop_rows(t))
    path = F.transform("route_path", lambda p: F.concat_ws(",", p["longitude"], p["latitude"]))
    arrays = [c for c in meta.columns if c.startswith("tt_") or c in ("stops", "stops_type", "platforms")]
    joined = {c: F.concat_ws("|", c) for c in arrays} | {"route_path": F.concat_ws("|", path)}
    return meta.withColumns(joined)


@query(
    "p30_route_meta_station",
    f"""with {STOP_ROWS} select train_uid, train_signalling_id, string_agg(location_name, '|' order by {ORDERED}) as stops
        from rows group by {ROUTE} having bool_or(location_name = 'STATION 7')""",
    ("stop", "schedule", "geo", "toc"),
)
def _(t):
    meta = timetable.route_meta(stop_rows(t), station="STATION 7")
    return meta.select("train_uid", "train_signalling_id", F.concat_ws("|", "stops").alias("stops"))


@query(
    "p30_timetable_rows",
    f"""with {STOP_ROWS} select {ROUTE}, cast(0 as bigint) as page, cast(row_number() over (partition by {ROUTE} order by {ORDERED}) - 1 as integer) as stop_no,
        location_name as station, coalesce(platform, '--') as platform, location_type_desc as type, coalesce(arr_pub, '--') as arr_public,
        coalesce(dep_pub, '--') as dep_public, '--' as arr_timetable, '--' as dep_timetable, coalesce(pass_wtt, '--') as pass_timetable from rows""",
    ("stop", "schedule", "geo", "toc"),
)
def _(t):
    return timetable.timetable_rows(timetable.route_meta(stop_rows(t)))


@query(
    "p31_associations",
    """select distinct assoc_train_uid, associated_type, assoc_location from association
        where date '2024-01-10' between assoc_start_date and assoc_end_date and wednes_service""",
    ("association",),
)
def _(t):
    return timetable.associations_on(t.role("association"), DAY)


# ---- live snapshot -----------------------------------------------------------------------------------


@query(
    "p32_station_snapshot",
    f"""with {STATUS} select train_id, location_name, cast(actual_timestamp as varchar) as scheduled_event_timestamp
        from status s join location l on s.location_id = l.location_id where location_name = 'STATION 5'""",
    ("movement", "location"),
)
def _(t):
    status = marts.train_status(t.role("movement")).join(t.role("location"), "location_id")
    trains = status.select(
        "train_id", "location_name", F.col("actual_timestamp").alias("scheduled_event_timestamp")
    )
    return live.station_snapshot(trains, "STATION 5")


@query(
    "p33_stations_with_coordinates",
    "select location_id, location_name, latitude, longitude from geo where latitude is not null",
    ("geo",),
)
def _(t):
    return timetable.stations_with_coordinates(t.role("geo"))


# ---- performance -------------------------------------------------------------------------------------

METRICS = """
    cast(sum(timetable_variation) as bigint) as sum_delay_mins, count(*) as total_events,
    count(*) filter (event_type = 'DEPARTURE') as total_departures, count(*) filter (event_type = 'ARRIVAL') as total_arrivals,
    count(*) filter (timetable_variation <= 0) as on_time_events, count(*) filter (timetable_variation between 1 and 5) as slight_delay_events,
    count(*) filter (timetable_variation between 6 and 10) as delay_events, count(*) filter (timetable_variation > 10) as major_delay_events
"""
STATION = f"""
    joined as (select l.station_id, l.location_name, cast(m.planned_timestamp as date) as service_date, m.timetable_variation, m.event_type, t.toc_name
               from movement m left join location l on m.location_id = l.location_id left join toc t on m.toc_id = t.toc_id
               where m.actual_timestamp is not null and l.location_name is not null),
    totals as (select station_id, location_name, service_date, {METRICS} from joined group by all)
"""
STATION_TABLES = ("movement", "location", "toc")


def station_inputs(t):
    return t.role("movement"), t.role("location"), t.role("toc")


@query(
    "p34_station_performance",
    f"""with {STATION}, worst as (select station_id, location_name, service_date, toc_name as toc, timetable_variation as delay from joined
            qualify row_number() over (partition by station_id, location_name, service_date order by timetable_variation desc nulls last, toc_name nulls first) <= 5)
        select * replace (cast(service_date as varchar) as service_date),
               round(on_time_events / total_events, 6) as pct_on_time, round(sum_delay_mins / total_events, 6) as avg_delay_mins
        from totals join worst using (station_id, location_name, service_date)""",
    STATION_TABLES,
)
def _(t):
    perf = performance.station_performance(*station_inputs(t))
    return perf.withColumns({c: F.round(c, 6) for c in ("pct_on_time", "avg_delay_mins")})


ROUTE_PERF = f"""
    route_perf as (select r.train_uid, r.origin, r.terminating, r.route_desc, m.service_date, sum_delay_mins, total_events, total_departures,
        total_arrivals, on_time_events, slight_delay_events, delay_events, major_delay_events
        from (select d.schedule_id, d.train_uid, cast(planned_timestamp as date) as service_date, {METRICS}
              from movement m left join schedule d on m.schedule_id = d.schedule_id where actual_timestamp is not null group by 1, 2, 3) m
        left join routes r on m.train_uid = r.train_uid and m.schedule_id = r.schedule_id where r.route_desc is not null)
"""
ROUTE_TABLES = ("movement", "schedule", "stop", "location")


def route_perf(t, per="uid"):
    routes = marts.route_start_stop(t.role("stop"), t.role("schedule"), t.role("location"), per)
    return performance.route_performance(t.role("movement"), t.role("schedule"), routes)


@query(
    "p35_route_performance",
    f"with {ROUTES}, {ROUTE_PERF} select * replace (cast(service_date as varchar) as service_date) from route_perf",
    ROUTE_TABLES,
)
def _(t):
    return route_perf(t)


@query(
    "p35_route_performance_per_schedule",
    f"""with {ROUTES}, {ROUTE_PERF.replace("left join routes", "left join all_routes")}
        select * replace (cast(service_date as varchar) as service_date) from route_perf""",
    ROUTE_TABLES,
)
def _(t):
    return route_perf(t, per="schedule")


def search_sql(time: str) -> str:
    return f"""with {STOP_ROWS},
        calls as (select *, {time} as shown from rows where location_name = 'STATION 7'
                  qualify row_number() over (partition by {ROUTE} order by loc_offset, location_type_desc desc, longitude desc, latitude desc,
                      arr_pub desc nulls last, dep_pub desc nulls last, pass_wtt desc nulls last, platform desc nulls last) = 1),
        ends as (select {ROUTE}, arg_min(location_name, o) as origin_stop, arg_max(location_name, o) as last_stop
                 from (select *, row_number() over (partition by {ROUTE} order by loc_offset, location_name) as o from rows) group by {ROUTE})
        select c.train_uid, coalesce(c.platform, '--') as platform, e.origin_stop, e.last_stop, '2024-01-10 ' || c.shown as display_time
        from calls c join ends e on {" and ".join(f"c.{x} is not distinct from e.{x}" for x in timetable.ROUTE)}
        where c.shown between '09:00:00' and '15:00:00'"""


AT = dt.datetime(2024, 1, 10, 12, 0)


@query("p36_station_search", search_sql("coalesce(dep_pub, arr_pub, pass_wtt)"), ("stop", "schedule", "geo", "toc"))
def _(t):
    return timetable.station_search(stop_rows(t), "STATION 7", AT, 180)


@query("p36_station_search_strict", search_sql("dep_pub"), ("stop", "schedule", "geo", "toc"))
def _(t):
    return timetable.station_search(stop_rows(t), "STATION 7", AT, 180, strict=True)


def share_sql(index: str, where: str = "true") -> str:
    return f"""with {ROUTES}, {DELAY}
        select i.{index}, c.delay_category, round(100.0 * count(d.delay_category) / any_value(i.n), 6) as percent
        from (select {index}, count(*) as n from delays where {index} is not null and {where} group by 1) i
        cross join (values ('on_time'), ('slight_delay'), ('delay'), ('major_delay')) c(delay_category)
        left join (select * from delays where {where}) d on d.{index} = i.{index} and d.delay_category = c.delay_category group by 1, 2"""


DELAY_TABLES = ("stop", "schedule", "location", "movement", "toc")


@query("p37_delay_share_by_operator", share_sql("toc_name"), DELAY_TABLES)
def _(t):
    return performance.delay_share_by_operator(delays(t)).withColumn("percent", F.round("percent", 6))


@query("p37_delay_share_by_route", share_sql("route_desc", "toc_name = 'NATION_7'"), DELAY_TABLES)
def _(t):
    return performance.delay_share_by_route(delays(t), "NATION_7").withColumn("percent", F.round("percent", 6))


@query(
    "p38_station_leaderboard",
    f"""with {STATION} select station_id, location_name, cast(sum(total_events) as bigint) as total_events, cast(sum(sum_delay_mins) as bigint) as sum_delay_mins,
        round(avg(sum_delay_mins / total_events), 6) as avg_delay, round(avg(on_time_events / total_events), 6) as pct_on_time from totals group by 1, 2""",
    STATION_TABLES,
)
def _(t):
    board = performance.station_leaderboard(performance.station_totals(*station_inputs(t)))
    return board.withColumns({c: F.round(c, 6) for c in ("avg_delay", "pct_on_time")})


@query(
    "p38_route_leaderboard",
    f"""with {ROUTES}, {ROUTE_PERF} select train_uid, route_desc, cast(sum(total_events) as bigint) as total_events,
        cast(sum(sum_delay_mins) as bigint) as sum_delay_mins from route_perf group by 1, 2""",
    ROUTE_TABLES,
)
def _(t):
    return performance.route_leaderboard(route_perf(t))


@query(
    "p38_station_headline",
    f"""with {STATION} select cast(sum(total_events) as bigint) as total_events, cast(sum(sum_delay_mins) as bigint) as total_delay,
        round(avg(on_time_events / total_events), 6) as pct_on_time from totals""",
    STATION_TABLES,
)
def _(t):
    figures = performance.headline_figures(performance.station_totals(*station_inputs(t)))
    return figures.withColumn("pct_on_time", F.round("pct_on_time", 6))


@query(
    "p38_delay_distribution",
    f"""with {STATION}, top as (select * from totals order by service_date desc, sum_delay_mins desc nulls last, station_id, location_name limit 1)
        select 'On Time' as category, on_time_events as count from top union all select '1-5 min', slight_delay_events from top
        union all select '6-10 min', delay_events from top union all select '>10 min', major_delay_events from top""",
    STATION_TABLES,
)
def _(t):
    return performance.delay_distribution(
        performance.station_totals(*station_inputs(t)), ["station_id", "location_name"]
    )


@query(
    "p38_worst_routes",
    f"with {ROUTES}, {ROUTE_PERF} select train_uid, route_desc, sum_delay_mins from route_perf",
    ROUTE_TABLES,
)
def _(t):
    return performance.worst_contributors(route_perf(t), ["train_uid", "route_desc", "sum_delay_mins"], "sum_delay_mins")


@query(
    "p38_route_headline",
    f"""with {ROUTES}, {ROUTE_PERF} select cast(sum(total_events) as bigint) as total_events, cast(sum(sum_delay_mins) as bigint) as total_delay from route_perf""",
    ROUTE_TABLES,
)
def _(t):
    return performance.headline_figures(route_perf(t))


@query(
    "p38_route_distribution",
    f"""with {ROUTES}, {ROUTE_PERF}, top as (select * from route_perf order by service_date desc, sum_delay_mins desc nulls last, train_uid limit 1)
        select 'On Time' as category, on_time_events as count from top union all select '1-5 min', slight_delay_events from top
        union all select '6-10 min', delay_events from top union all select '>10 min', major_delay_events from top""",
    ROUTE_TABLES,
)
def _(t):
    return performance.delay_distribution(route_perf(t), ["train_uid"])


@query(
    "p38_worst_operators",
    f"""with {STATION} select toc_name as toc, timetable_variation as delay from joined
        qualify row_number() over (partition by station_id, location_name, service_date order by timetable_variation desc nulls last, toc_name nulls first) <= 5""",
    STATION_TABLES,
)
def _(t):
    return performance.worst_contributors(performance.station_performance(*station_inputs(t)), ["toc", "delay"], "delay")


# ---- live ----------------------------------------------------------------------------------------


@query(
    "p39_combined_board",
    f"""with {STATUS}, live as (select * from status qualify row_number() over (partition by train_id order by event_type, location_id, next_location_id, toc_id, timetable_variation nulls first) = 1),
        named as (select s.*, l.location_name, t.toc_name from live s left join location l on s.location_id = l.location_id left join toc t on s.toc_id = t.toc_id)
        select train_id as "Train ID", null::varchar as "Train UID", toc_name as "Operator", location_name as "Current Station",
               case when event_type = 'ARRIVAL' then 'next' end as "Next Station", planned_event_type as "Planned Type", cast(planned_timestamp as varchar) as "Planned Time",
               timetable_variation as "Variation", variation_status as "Status", cast(actual_timestamp as varchar) as "Last Update"
        from named where event_type in ('ARRIVAL', 'PASS')""",
    ("movement", "location", "toc"),
)
def _(t):
    status = marts.train_status(t.role("movement"))
    order = ["event_type", "location_id", "next_location_id", "toc_id", F.asc_nulls_first("timetable_variation")]
    latest = first_k(status, ["train_id"], order, 1)
    snapshot = (
        latest.join(t.role("location").select("location_id", "location_name"), "location_id", "left")
        .withColumn("train_uid", F.lit(None).cast("string"))
        .filter(F.col("event_type").isin("ARRIVAL", "PASS"))
    )
    states = (
        snapshot.filter(F.col("event_type") == "ARRIVAL")
        .join(t.role("toc").select("toc_id", "toc_name"), "toc_id", "left")
        .withColumns({"next_station": F.lit("next"), "last_update": F.col("actual_timestamp")})
    )
    return live.combined_board(live.live_board(states), live.snapshot_board(snapshot, t.role("toc")))


DAILY_COUNTS = {
    "rail_schedule_raw": "select (select count(*) from in_schedule) + (select count(*) from in_association) + (select count(*) from in_tiploc)",
    "stg_activation": "select count(distinct train_id) from in_activation where ingest_ts >= timestamp '2024-02-02'",
    "stg_movement": "select count(*) from (select distinct train_id, loc_stanox, actual_timestamp from in_movement where ingest_ts >= timestamp '2024-02-02')",
    "stg_describer": "select count(*) from (select distinct area_id, event_ts, from_berth, to_berth, descr from in_describer)",
    "stg_schedule": "select count(*) from (select distinct train_uid, start_date, end_date, stp from in_schedule)",
    "stg_association": "select count(distinct k) from in_association",
    "stg_tiploc": "select count(distinct tiploc_code) from in_tiploc",
    "dim_location": "select count(*) from dim_location",
    "dim_geo": "select count(*) from dim_geo",
    "dim_toc": "select count(*) from dim_toc",
    "dim_area": "select count(*) from dim_area",
    "dim_signal_berth": "select count(*) from dim_signal_berth",
    "dim_train_schedule": "select count(*) from (select distinct train_uid, start_date, end_date, stp from in_schedule)",
    "dim_train_association": "select count(distinct k) from in_association",
    "bridge_signal_berth_to_location": "select count(*) from dim_signal_berth b join dim_location l on b.station_id = l.station_id",
    "fact_train_activation": """select count(*) from (select distinct on (train_id) * from in_activation where ingest_ts >= timestamp '2024-02-02') a
        left join dim_toc t on a.toc_id = t.toc_operating_code""",
}


@query(
    "p40_daily_run",
    " union all ".join(f"select '{name}' as table_name, ({sql}) as stored_rows" for name, sql in DAILY_COUNTS.items()),
    ("in_schedule", "in_association", "in_tiploc", "in_activation", "in_movement", "in_describer", "dim_location", "dim_geo", "dim_toc", "dim_area", "dim_signal_berth"),
)
def _(t):
    m = t.models
    warehouse = shared_dir(t.spark, "daily")
    dump = shared_dir(t.spark, "dump")
    m.dump_lines.select("value").write.option("compression", "gzip").text(dump)
    feeds = {"activation": m.activation_clean, "movement": m.movement_clean, "describer": m.describer_clean.withColumn("ingest_ts", F.lit(RUN_TS))}
    seeds = {
        "toc": m.toc_seed, "td_area": m.area_seed, "trust_corpus": m.corpus_seed, "td_smart": m.smart_seed,
        "stops": m.stops_seed, "train_category": m.category_seed,
    }
    paths = run_daily(t.spark, warehouse, feeds, seeds, RUN_TS, dump)
    paths["rail_schedule_raw"] = f"{warehouse}/raw/rail_schedule_raw"
    counts = [
        t.spark.read.parquet(paths[name]).agg(F.count("*").alias("stored_rows")).select(F.lit(name).alias("table_name"), "stored_rows")
        for name in DAILY_COUNTS
    ]
    return reduce(DataFrame.unionByName, counts)


@query(
    "p41_associated_routes",
    f"""with {STOP_ROWS}, links as (select distinct assoc_train_uid, associated_type, assoc_location from association
            where date '2024-01-10' between assoc_start_date and assoc_end_date and wednes_service)
        select l.*, r.loc_offset, r.location_name, r.longitude, r.latitude, coalesce(r.location_name = l.assoc_location, false) as is_association_place
        from links l join rows r on l.assoc_train_uid = r.train_uid""",
    ("stop", "schedule", "geo", "toc", "association"),
)
def _(t):
    return timetable.associated_routes(
        t.role("association"), t.role("stop"), t.role("schedule"), t.role("geo"), t.role("toc"), DAY
    )
