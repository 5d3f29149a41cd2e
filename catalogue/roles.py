"""Rail-shaped tables derived from the test tables.

Each text is valid in Spark SQL and in the checking engine alike; ``{orders}`` and so on
stand for the test tables. MODELS (see models_sql) build on them in the checking engine.
"""

from __future__ import annotations

import re

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

UID = "'U' || lpad(cast({k} as string), 6, '0')"
SIGNAL = (
    "cast({k} % 10 as string) || chr(cast(65 + {k} % 26 as int)) || lpad(cast({k} % 100 as string), 2, '0')"
)


def mask(k: str) -> str:
    """Seven day flags, Monday first, from the low bits of a key."""
    return " || ".join(f"cast(cast(floor(({k} % 128) / {2 ** b}) as bigint) % 2 as string)" for b in range(6, -1, -1))


def flags(k: str) -> str:
    names = ("mon", "tue", "wednes", "thrus", "fri", "sat", "sun")
    return ", ".join(
        f"cast(floor(({k} % 128) / {2 ** (6 - i)}) as bigint) % 2 = 1 as {n}_service" for i, n in enumerate(names)
    )


STP = "case when o_orderkey % 10 = 0 then 'C' when o_orderstatus = 'F' then 'N' else o_orderstatus end"
START = "date '2024-01-01' + cast(o_orderkey % 30 as int)"
END = "date '2024-01-01' + cast(o_orderkey % 30 + o_orderkey % 5 as int)"

ROLES: dict[str, str] = {
    # ---- rail-shaped inputs -------------------------------------------------------
    "in_schedule": f"""
        select o_orderkey as k, {UID.format(k="o_custkey")} as train_uid, {STP} as stp,
               {START} as start_date, {END} as end_date, {mask("o_orderkey")} as day_mask,
               {SIGNAL.format(k="o_custkey")} as signalling_id,
               'C' || cast(o_orderkey % 30 as string) as category_code,
               case o_orderkey % 4 when 0 then 'DMU' when 1 then 'EMU' when 2 then 'HST' else 'XX' end as power_code,
               case o_orderkey % 3 when 0 then 'B' when 1 then 'Q' else '?' end as operating_code,
               case o_orderkey % 5 when 0 then 'A' when 1 then 'E' when 2 then 'R' when 3 then 'S' end as reservation_code,
               case o_orderkey % 6 when 0 then 'P' when 1 then 'F' when 2 then '1' when 3 then 'B' when 4 then '5' else 'x' end as status_code,
               case o_orderkey % 9 when 0 then 'X' when 1 then 'G' end as holiday_code,
               cast(60 + o_orderkey % 65 as string) as speed,
               case when o_custkey % 7 = 0 then '   ' else ' ' || lpad(cast(o_custkey % 1000 as string), 8, '2') end as service_code,
               'A' || cast(o_custkey % 28 as string) as atoc_code,
               case when o_orderkey % 11 = 0 then null else 'Y' end as timetable,
               case when o_orderkey % 3 = 0 then timestamp '2024-02-01 02:00:00' else timestamp '2024-02-02 02:00:00' end as ingest_ts
        from {{orders}}""",
    "in_stop": f"""
        select o_orderkey as k, i, case when i = 0 then 'LO' when i = 1 + o_orderkey % 3 then 'LT' else 'LI' end as kind,
               'TIP' || cast((o_orderkey + 13 * i) % 1000 as string) as tiploc,
               case when i > 0 then lpad(cast(6 + 4 * i + o_orderkey % 3 as string), 2, '0') || lpad(cast(o_orderkey % 60 as string), 2, '0') || case when o_orderkey % 4 = 0 then 'H' else '' end end as arrival,
               case when i < 1 + o_orderkey % 3 then lpad(cast(6 + 4 * i + o_orderkey % 3 as string), 2, '0') || lpad(cast(o_orderkey % 70 as string), 2, '0') end as departure,
               case when i > 0 and o_orderkey % 2 = 0 then lpad(cast(6 + 4 * i + o_orderkey % 3 as string), 2, '0') || '30' else '' end as public_arrival,
               case when i = 0 then '0' || cast(6 + o_orderkey % 3 as string) || '15' end as public_departure,
               case when o_orderkey % 5 = 0 then '2400' end as pass,
               case when o_orderkey % 12 > 0 then cast(o_orderkey % 12 as string) end as platform,
               case o_orderkey % 6 when 0 then 'H' when 1 then '1' when 2 then '2H' when 3 then '12' when 4 then '1X' else '' end as allowance
        from {{orders}} cross join (select 0 as i union all select 1 union all select 2 union all select 3) as n
        where i < 2 + o_orderkey % 3""",
    "in_activation": f"""
        select lpad(cast(o_orderkey as string), 8, '0') as train_id, {UID.format(k="o_custkey")} as train_uid,
               {STP} as schedule_type, cast({START} as string) as schedule_start_date, cast({END} as string) as schedule_end_date,
               o_custkey % 30 as toc_id, o_orderdate as creation_timestamp,
               o_orderdate + cast(o_orderkey % 24 as int) * interval '1' hour as origin_dep_timestamp,
               o_orderpriority as schedule_source, o_custkey % 1000 as tp_origin_stanox,
               timestamp '2024-02-01 06:00:00' as ingest_ts
        from {{orders}}
        union all
        select lpad(cast(o_orderkey as string), 8, '0'), {UID.format(k="o_custkey")}, {STP}, cast({START} as string), cast({END} as string),
               (o_custkey + 1) % 30, o_orderdate, o_orderdate + cast(o_orderkey % 24 as int) * interval '1' hour,
               'newer', o_custkey % 1000, timestamp '2024-02-02 06:00:00'
        from {{orders}} where o_orderpriority = '1-URGENT'""",
    "in_movement": """
        select lpad(cast(l_orderkey as string), 8, '0') as train_id, l_partkey % 30 as toc_id,
               (l_orderkey + 13 * (l_linenumber % 4)) % 1000 as loc_stanox,
               case when l_partkey % 50 = 0 then 900000 else (l_orderkey + 13 * ((l_linenumber + 1) % 4)) % 1000 end as next_report_stanox,
               l_shipdate + cast(l_linenumber as int) * interval '1' hour as actual_timestamp,
               case l_returnflag when 'A' then 'ARRIVAL' when 'R' then 'DEPARTURE' else 'PASS' end as event_type,
               cast(l_quantity as bigint) - 20 as timetable_variation, l_linestatus as variation_status,
               cast(l_suppkey % 20 as string) as platform, l_linestatus = 'O' as train_terminated,
               timestamp '2024-02-01 06:00:00' as ingest_ts
        from {lineitem}
        union all
        select lpad(cast(l_orderkey as string), 8, '0'), l_partkey % 30, (l_orderkey + 13 * (l_linenumber % 4)) % 1000,
               l_partkey, l_shipdate + cast(l_linenumber as int) * interval '1' hour, 'ARRIVAL',
               cast(l_quantity as bigint) + 100, l_linestatus, cast(null as string), false,
               timestamp '2024-02-02 06:00:00'
        from {lineitem} where l_returnflag = 'A'""",
    "in_describer": f"""
        select event_id, case when event_type = 'error' then 'CT' else 'CA' end as msg_type,
               'A' || cast(event_id % 30 as string) as area_id, date_trunc('millisecond', ts) as event_ts,
               lpad(cast(event_id % 50 as string), 4, '0') as from_berth, lpad(cast(event_id % 49 as string), 4, '0') as to_berth,
               case when event_id % 23 = 0 then '  ' else ' ' || {SIGNAL.format(k="user_id")} end as descr,
               event_type as report_time
        from {{events}}""",
    "in_tiploc": """
        select s_suppkey as stanox, ' tip' || cast(s_suppkey as string) || ' ' as tiploc_code, s_suppkey * 10 as nalco,
               case when s_suppkey % 3 = 0 then ' ' else 'x' || cast(s_suppkey % 100 as string) end as crs_code,
               s_name as description, timestamp '2024-02-02 02:00:00' as ingest_ts
        from {supplier}
        union all
        select s_suppkey, ' tip' || cast(s_suppkey as string) || ' ', s_suppkey * 10, 'old', 'OLD ' || s_name, timestamp '2024-02-01 02:00:00'
        from {supplier} where s_acctbal > 0""",
    "in_corpus": """
        select c_custkey * 10 as nlc, case when c_custkey % 17 = 0 then null else c_custkey end as stanox,
               case when c_custkey % 5 = 0 then 'trx' else 'Tip' end || cast(c_custkey as string) as tiploc,
               case when c_custkey % 4 = 0 then '' else substr(c_mktsegment, 1, 3) end as three_alpha,
               case when c_custkey % 13 = 0 then null else c_name end as nlc_desc
        from {customer}""",
    "in_toc": """
        select n_name as company, ' B' || cast(n_nationkey as string) as business_code,
               case when n_nationkey = 24 then ' ?' when n_nationkey = 23 then ' ' when n_nationkey = 22 then ' 21' else ' ' || cast(n_nationkey as string) end as sector_code,
               case when n_nationkey % 6 = 5 then ' ZZ' else ' A' || cast(n_nationkey as string) end as atoc_code
        from {nation}""",
    "in_area": """
        select 'A' || cast(n_nationkey as string) as area_id, n_name as name, n_nationkey % 2 = 0 as sig, n_nationkey % 3 = 0 as rte,
               n_nationkey % 5 = 0 as lat, n_nationkey % 7 = 0 as trk, n_regionkey = 0 as pts, n_regionkey = 1 as lxg
        from {nation}""",
    "in_smart": """
        select p_brand as step_type, lpad(cast(p_partkey % 50 as string), 4, '0') as from_berth,
               lpad(cast(p_partkey % 49 as string), 4, '0') as to_berth, cast(p_partkey % 1000 as string) as stanox, 'A' as event,
               case when p_size % 5 = 0 then cast(p_size as string) || 'A' else cast(p_size as string) end as platform,
               'X' as to_line, cast(p_size % 9 as string) as berth_offset, cast(p_partkey as string) as route, 'Y' as from_line,
               case when p_partkey % 41 = 0 then null else 'A' || cast(p_partkey % 30 as string) end as td, p_type as comment, p_name as stanme
        from {part}""",
    "in_stops": """
        select case when c_custkey % 3 = 0 then '9100BUS' else '9100TIP' end || cast(c_custkey as string) as atcocode, cast(50 + c_custkey % 8 as double) + 0.25 as latitude,
               cast(c_custkey % 6 as double) - 4.5 as longitude, c_custkey * 100 as easting, c_custkey * 50 as northing, 'RLY' as stoptype
        from {customer}""",
    "in_category": """
        select 'C' || cast(n_nationkey as string) as code, n_name as category, 'Region ' || cast(n_regionkey as string) as description
        from {nation}""",
    "in_association": f"""
        select c_custkey as k, {UID.format(k="c_custkey")} as main_uid, {UID.format(k="(c_custkey + 1)")} as assoc_uid,
               date '2024-01-01' + cast(c_custkey % 20 as int) as start_date, date '2024-01-01' + cast(c_custkey % 20 + 10 as int) as end_date,
               {mask("c_custkey")} as day_mask, case c_custkey % 4 when 0 then 'JJ' when 1 then 'NP' when 2 then 'VV' else 'XX' end as category,
               case c_custkey % 4 when 0 then 'S' when 1 then 'N' when 2 then 'P' end as date_indicator,
               'TIP' || cast(c_custkey % 100 as string) as location, case when c_custkey % 9 = 0 then 'C' else 'P' end as stp,
               timestamp '2024-02-02 02:00:00' as ingest_ts
        from {{customer}}
        union all
        select c_custkey, {UID.format(k="c_custkey")}, {UID.format(k="(c_custkey + 1)")},
               date '2024-01-01' + cast(c_custkey % 20 as int), date '2024-01-01' + cast(c_custkey % 20 + 10 as int),
               '0000000', case c_custkey % 4 when 0 then 'JJ' when 1 then 'NP' when 2 then 'VV' else 'XX' end, 'S',
               'TIP' || cast(c_custkey % 100 as string), case when c_custkey % 9 = 0 then 'C' else 'P' end,
               timestamp '2024-02-01 02:00:00'
        from {{customer}} where c_mktsegment = 'BUILDING'""",
    # ---- star schema read by marts and queries ----------------------------------------
    "movement": """
        select cast(l_orderkey as string) as train_id, cast(l_orderkey as string) as schedule_id,
               cast(l_suppkey as string) as location_id, cast(l_partkey % 120 as string) as next_location_id,
               cast(l_suppkey % 30 as string) as toc_id, l_linenumber as loc_offset, l_partkey as partkey,
               case when l_partkey % 97 = 0 then null else l_shipdate + cast(l_linenumber as int) * interval '1' hour end as actual_timestamp,
               l_shipdate as planned_timestamp,
               case l_returnflag when 'A' then 'ARRIVAL' when 'R' then 'DEPARTURE' else 'PASS' end as event_type,
               case l_linestatus when 'O' then 'ARRIVAL' else 'DEPARTURE' end as planned_event_type,
               case when l_partkey % 53 = 0 then null else cast(l_quantity as bigint) - 20 end as timetable_variation,
               l_linestatus as variation_status, l_partkey % 30 as next_report_run_time,
               cast(round(l_extendedprice * 100) as bigint) as price
        from {lineitem}""",
    "stop": """
        select cast(l_orderkey as string) as schedule_id, cast(l_suppkey as string) as location_id, l_linenumber as loc_offset,
               case l_returnflag when 'A' then 'Intermediate location' else 'Terminating location' end as location_type_desc,
               case when l_partkey % 2 = 0 then lpad(cast(2 * l_linenumber + l_partkey % 8 as string), 2, '0') || ':' || lpad(cast(l_partkey % 60 as string), 2, '0') || ':00' end as arrival_public_timetable_time,
               case when l_partkey % 3 = 0 then lpad(cast(2 * l_linenumber + l_partkey % 8 as string), 2, '0') || ':45:00' end as departure_public_timetable_time,
               cast(null as string) as arrival_working_timetable_time, cast(null as string) as departure_working_timetable_time,
               case when l_partkey % 5 <> 0 then lpad(cast(2 * l_linenumber + l_partkey % 8 as string), 2, '0') || ':10:00' end as passing_working_timetable_time,
               case when l_partkey % 4 > 0 then cast(l_partkey % 12 as string) end as platform, l_linestatus as line, l_partkey as partkey,
               cast(round(l_extendedprice * 100) as bigint) as price
        from {lineitem}""",
    "schedule": f"""
        select cast(o_orderkey as string) as schedule_id, {UID.format(k="o_custkey")} as train_uid,
               {SIGNAL.format(k="o_custkey")} as train_signalling_id, 'A' || cast(o_custkey % 28 as string) as atoc_code,
               {STP} as stp_indicator, {STP} as short_term_planning_schedule_indicator,
               {START} as schedule_start_date, {END} as schedule_end_date, 60 + o_custkey % 40 as planned_speed,
               case when o_custkey % 8 = 0 then null else 'Category ' || cast(o_custkey % 8 as string) end as train_category,
               'D' || cast(o_custkey % 8 as string) as train_category_desc,
               case when o_custkey % 3 = 0 then null else 'Status ' || cast(o_custkey % 3 as string) end as train_status_desc,
               'R' || cast(o_custkey % 2 as string) as reservations_desc, 'UNKNOWN' as operating_characteristic_desc,
               case when o_orderkey % 5 = 0 then null else 'Power ' || cast(o_orderkey % 5 as string) end as power_type_desc,
               {flags("o_orderkey")}, o_orderkey as k
        from {{orders}}""",
    "location": """
        select cast(s_suppkey as string) as location_id, s_nationkey as station_id, s_name as tiploc_code,
               case when s_suppkey % 19 = 0 then null else 'STATION ' || cast(s_suppkey % 1000 as string) end as location_name,
               'S' || cast(s_suppkey % 100 as string) as crs_code
        from {supplier}""",
    "geo": """
        select cast(s_suppkey as string) as location_id, s_suppkey as station_id, 'STATION ' || cast(s_suppkey % 1000 as string) as location_name,
               case when s_suppkey % 11 = 0 then null else cast(50 + s_suppkey % 8 as double) + 0.25 end as latitude,
               cast(s_suppkey % 6 as double) - 4.5 as longitude
        from {supplier}""",
    "toc": """
        select cast(n_nationkey as string) as toc_id, n_name as toc_name, n_nationkey as toc_operating_code,
               'A' || cast(n_nationkey as string) as toc_schedule_code
        from {nation}""",
    "association": f"""
        select {UID.format(k="c_custkey")} as main_train_uid, {UID.format(k="(c_custkey + 1)")} as assoc_train_uid,
               date '2024-01-01' + cast(c_custkey % 20 as int) as assoc_start_date, date '2024-01-01' + cast(c_custkey % 20 + 10 as int) as assoc_end_date,
               case c_custkey % 4 when 0 then 'Join' when 1 then 'Next' when 2 then 'Divide' end as associated_type,
               'STATION ' || cast(c_custkey % 100 as string) as assoc_location, {flags("c_custkey")}
        from {{customer}}""",
}

MODELS: dict[str, str] = {}  # filled by models_sql


def with_tables(sql: str, uses: tuple[str, ...]) -> str:
    """The SQL with every derived table it needs as a common table expression before it."""
    order: list[str] = []

    def add(name: str) -> None:
        if name in order:
            return
        text = MODELS.get(name) or ROLES[name]
        for other in (*MODELS, *ROLES):
            if other != name and re.search(rf"\b(from|join)\s+{other}\b", text, re.I):
                add(other)
        order.append(name)

    for name in uses:
        add(name)

    def body(name: str) -> str:
        text = MODELS.get(name) or ROLES[name]
        for table in BASE_TABLES:
            text = text.replace(f"{{{table}}}", f"main.{table}" if name == table else table)
        return text

    sql = sql.strip()
    if not order:
        return sql
    ctes = ",\n".join(f"{name} as ({body(name)})" for name in order)
    if sql.lower().startswith("with "):
        return f"with {ctes},\n{sql[5:]}"
    return f"with {ctes}\n{sql}"
