"""D-01 to D-11: filters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catalogue.registry import query
from railmill import functions as fn
from railmill.functions.labels import DAY_FLAGS
from railmill.operators import filters

C = F.col
DAY = dt.date(2024, 1, 10)
AS_OF = dt.datetime(2024, 1, 10, 12, 0)


@query("d01_record_type", "select event_id, event_type as record_type from events where event_type = 'click'")
def _(t):
    return filters.record_type(t.events.select("event_id", C("event_type").alias("record_type")), "click")


@query(
    "d02_not_null_and_unequal",
    """select schedule_id, stp_indicator from schedule where stp_indicator <> 'C' and train_category is not null and power_type_desc is not null""",
    ("schedule",),
)
def _(t):
    kept = t.role("schedule").filter(
        (C("stp_indicator") != "C") & C("train_category").isNotNull() & C("power_type_desc").isNotNull()
    )
    return kept.select("schedule_id", "stp_indicator")


@query(
    "d03_latest_partition",
    "select event_id, event_type from events where cast(ts as date) = (select max(cast(ts as date)) from events)",
)
def _(t):
    return filters.latest_partition(t.events, F.to_date("ts")).select("event_id", "event_type")


@query(
    "d04_runs_on_date",
    "select schedule_id, train_uid from schedule where date '2024-01-10' between schedule_start_date and schedule_end_date and wednes_service",
    ("schedule",),
)
def _(t):
    running = t.role("schedule").filter(fn.runs_on(DAY, "schedule_start_date", "schedule_end_date"))
    return running.select("schedule_id", "train_uid")


@query(
    "d04_runs_on_row_date",
    """select schedule_id, cast(cast(o_orderdate as date) as varchar) as day,
        case dayofweek(o_orderdate) when 1 then mon_service when 2 then tue_service when 3 then wednes_service when 4 then thrus_service
             when 5 then fri_service when 6 then sat_service else sun_service end as runs from schedule join orders on k = o_orderkey""",
    ("schedule",),
)
def _(t):
    joined = t.role("schedule").join(t.orders, C("k") == C("o_orderkey"))
    day = F.to_date("o_orderdate")
    runs = fn.runs_on_column(day, F.lit(dt.date(1900, 1, 1)), F.lit(dt.date(2100, 1, 1)), [C(f) for f in DAY_FLAGS])
    return joined.select("schedule_id", day.alias("day"), runs.alias("runs"))


@query(
    "d05_optional_equals",
    """select 'one' as asked, count(*) as customers from customer where c_mktsegment = 'BUILDING' union all select 'any', count(*) from customer""",
)
def _(t):
    parts = []
    for asked, value in (("one", "BUILDING"), ("any", None)):
        rows = filters.optional_equals(t.customer, "c_mktsegment", value)
        parts.append(rows.agg(F.count("*").alias("customers")).select(F.lit(asked).alias("asked"), "customers"))
    return parts[0].unionByName(parts[1])


@query(
    "d06_array_membership",
    "select l_orderkey from lineitem group by l_orderkey having list_contains(list(l_suppkey), 7)",
)
def _(t):
    # tested row by row before grouping, so that no array of a hot order is ever built
    return t.lineitem.groupBy("l_orderkey").agg(F.bool_or(C("l_suppkey") == 7).alias("has")).filter("has").drop("has")


@query(
    "d07_around_moment",
    "select event_id, event_type from events where ts between timestamp '2024-01-10 11:00:00' and timestamp '2024-01-10 13:00:00'",
)
def _(t):
    near = t.events.filter(filters.within(C("ts").cast("timestamp"), AS_OF, dt.timedelta(hours=1)))
    return near.select("event_id", "event_type")


@query(
    "d08_time_of_day_window",
    """select event_id, '2024-01-10 ' || strftime(date_trunc('second', ts), '%H:%M:%S') as shown from events
        where strftime(date_trunc('second', ts), '%H:%M:%S') between '11:15:00' and '12:45:00'""",
)
def _(t):
    shown = fn.at_time_of_day(F.lit(DAY), F.date_format("ts", "HH:mm:ss"))
    rows = t.events.select("event_id", shown.alias("shown"))
    return rows.filter(filters.within(C("shown"), AS_OF, dt.timedelta(minutes=45)))


@query(
    "d09_facets",
    "select p_partkey, p_brand, p_type from part where p_brand in ('Brand#1', 'Brand#2', 'Brand#3') and p_type in ('SMALL', 'ECONOMY')",
)
def _(t):
    chosen = {"p_brand": ["Brand#1", "Brand#2", "Brand#3"], "p_type": ["SMALL", "ECONOMY"], "p_size": []}
    return filters.facet_filter(t.part, chosen).select("p_partkey", "p_brand", "p_type")


@query(
    "d10_at_or_approaching",
    "select train_id, location_id, next_location_id, price from movement where location_id = '5' or next_location_id = '5'",
    ("movement",),
)
def _(t):
    rows = filters.at_or_approaching(t.role("movement"), "5", "location_id", "next_location_id")
    return rows.select("train_id", "location_id", "next_location_id", "price")


@query(
    "d11_not_stale",
    "select event_id, event_type from events where ts >= timestamp '2024-01-30 11:55:00'",
)
def _(t):
    rows = filters.not_stale(t.events, dt.datetime(2024, 1, 30, 12, 0), column="ts")
    return rows.select("event_id", "event_type")
