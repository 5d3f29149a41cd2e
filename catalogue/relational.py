"""E joins, F aggregates, G windows, I sorts and top-k, J unions, K arrays."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catalogue.registry import query
from railmill import functions as fn
from railmill.functions.labels import DELAY_BUCKETS
from railmill.operators import aggregates, arrays, dedup, filters, joins
from railmill.plans import core, live
from railmill.session import shared_dir
from railmill.sources.tables import write_parquet

C = F.col
UNKNOWN = "md5('Unknown')"

# ---- E: joins --------------------------------------------------------------------------------


@query(
    "e01_left_join",
    "select l_orderkey, l_linenumber, l_extendedprice, s_name from lineitem left join supplier on l_suppkey = s_suppkey",
)
def _(t):
    names = t.supplier.select("s_suppkey", "s_name")
    joined = t.lineitem.join(names, C("l_suppkey") == C("s_suppkey"), "left")
    return joined.select("l_orderkey", "l_linenumber", "l_extendedprice", "s_name")


FOUR = "a.train_uid = s.train_uid and cast(a.schedule_start_date as date) = s.schedule_start_date and cast(a.schedule_end_date as date) = s.schedule_end_date and a.schedule_type = s.stp_indicator"


@query(
    "e02_four_key_left_join",
    f"""with one as (select * from schedule qualify row_number() over (partition by train_uid, schedule_start_date, schedule_end_date, stp_indicator order by schedule_id) = 1)
        select a.train_id, cast(a.ingest_ts as varchar) as ingest_ts, s.schedule_id from in_activation a left join one s on {FOUR}""",
    ("in_activation", "schedule"),
)
def _(t):
    left = t.role("in_activation").withColumns(
        {c: fn.strict_cast(C(c), "date") for c in ("schedule_start_date", "schedule_end_date")}
    )
    match = joins.equal_on("a", "s", core.SCHEDULE_MATCH)
    one = dedup.first_k(t.role("schedule"), [b for _, b in core.SCHEDULE_MATCH], ["schedule_id"], 1)
    joined = left.alias("a").join(one.alias("s"), match, "left")
    return joined.select("a.train_id", "a.ingest_ts", "s.schedule_id")


@query(
    "e03_inner_join",
    "select o_orderkey, o_custkey, l_linenumber, l_extendedprice from orders join lineitem on o_orderkey = l_orderkey",
)
def _(t):
    joined = t.orders.join(t.lineitem, C("o_orderkey") == C("l_orderkey"))
    return joined.select("o_orderkey", "o_custkey", "l_linenumber", "l_extendedprice")


@query(
    "e04_left_join_not_null",
    "select l_orderkey, l_linenumber, l_extendedprice, n_name from lineitem left join nation on l_suppkey = n_nationkey where n_nationkey is not null",
)
def _(t):
    joined = t.lineitem.join(t.nation, C("l_suppkey") == C("n_nationkey"), "left").filter(C("n_nationkey").isNotNull())
    return joined.select("l_orderkey", "l_linenumber", "l_extendedprice", "n_name")


@query(
    "e05_interval_join",
    """select event_id, o_orderkey from events join orders on user_id = o_custkey
        and cast(ts as date) between date '2024-01-01' + cast(o_orderkey % 30 as int) and date '2024-01-01' + cast(o_orderkey % 30 + o_orderkey % 5 as int)""",
)
def _(t):
    ranges = t.orders.select(
        "o_orderkey",
        "o_custkey",
        F.expr("date '2024-01-01' + cast(o_orderkey % 30 as int)").alias("start"),
        F.expr("date '2024-01-01' + cast(o_orderkey % 30 + o_orderkey % 5 as int)").alias("end"),
    )
    points = t.events.select("event_id", "user_id", "ts")
    joined = joins.interval_join(points, ranges, [("user_id", "o_custkey")], F.to_date("ts"), "start", "end", bin_days=7)
    return joined.select("p.event_id", "r.o_orderkey")


@query(
    "e06_two_roles",
    """select train_id, m.location_id, next_location_id, price, a.location_name, b.location_name as next_location_name
        from movement m left join location a on m.location_id = a.location_id left join location b on m.next_location_id = b.location_id""",
    ("movement", "location"),
)
def _(t):
    joined = joins.in_two_roles(
        t.role("movement"),
        t.role("location"),
        ("location_id", "next_location_id"),
        "location_id",
        {"location_name": ("location_name", "next_location_name")},
    )
    return joined.select("train_id", "location_id", "next_location_id", "price", "location_name", "next_location_name")


@query(
    "e07_differing_ends",
    """with ranked as (select schedule_id, location_id, row_number() over (partition by schedule_id order by loc_offset, location_id) as up,
            row_number() over (partition by schedule_id order by loc_offset desc, location_id desc) as down from stop)
        select a.schedule_id, a.location_id as origin_id, z.location_id as terminating_id
        from ranked a join ranked z on a.schedule_id = z.schedule_id and a.location_id <> z.location_id where a.up = 1 and z.down = 1""",
    ("stop",),
)
def _(t):
    ends = dedup.first_and_last(
        t.role("stop"), ["schedule_id"], ["loc_offset"], {"location_id": ("origin_id", "terminating_id")}
    )
    return ends.filter(C("origin_id") != C("terminating_id"))


@query(
    "e08_join_on_expression",
    "select c_custkey, s_suppkey from customer join supplier on substr(c_name, 10) = substr(s_name, 10)",
)
def _(t):
    condition = fn.text_from(C("c_name"), 10) == fn.text_from(C("s_name"), 10)
    return t.customer.join(t.supplier, condition).select("c_custkey", "s_suppkey")


STEP = "d.area_id = b.td and d.from_berth = b.from_berth and d.to_berth = b.to_berth"


@query(
    "e09_three_condition_join",
    f"select event_id, route from in_describer d left join in_smart b on {STEP}",
    ("in_describer", "in_smart"),
)
def _(t):
    on = joins.equal_on("d", "b", [("area_id", "td"), ("from_berth", "from_berth"), ("to_berth", "to_berth")])
    # the rows multiply here: merged, those of one step lie together and pack well, and no task is one file of the events
    joined = t.role("in_describer").alias("d").join(t.role("in_smart").hint("merge").alias("b"), on, "left")
    return joined.select("d.event_id", "b.route")


@query(
    "e10_or_unknown",
    f"select train_id, price, coalesce(md5(t.toc_id), {UNKNOWN}) as toc_key from movement m left join toc t on m.toc_id = t.toc_id",
    ("movement", "toc"),
)
def _(t):
    keys = t.role("toc").select("toc_id", fn.surrogate_key("toc_id").alias("key"))
    joined = t.role("movement").join(keys, "toc_id", "left")
    return joined.select("train_id", "price", joins.or_unknown(C("key")).alias("toc_key"))


ENRICH_DAY = dt.date(2024, 1, 10)


def enriched(t):
    movements = t.role("in_movement").withColumnsRenamed({"variation_status": "status"})
    geo = live.one_per_key(t.role("geo"), "station_id")
    # stored first, as the daily run does: one row per signalling id, so few that the movements need not be shuffled for them
    current = shared_dir(t.spark, "current")
    write_parquet(live.current_schedules(t.role("schedule"), ENRICH_DAY), current)
    return live.enrich_movements(movements, geo, t.spark.read.parquet(current), t.role("toc"))


ENRICHED = """
    current as (select train_signalling_id, train_uid from schedule
        where date '2024-01-10' between schedule_start_date and schedule_end_date
        qualify row_number() over (partition by train_signalling_id order by schedule_start_date desc, schedule_id) = 1),
    enriched as (select m.*, m.train_id[3:6] as train_signalling_id, c.train_uid,
        case when g.station_id is not null and n.station_id is not null then g.latitude end as latitude,
        case when g.station_id is not null and n.station_id is not null then g.longitude end as longitude,
        case when g.station_id is not null and n.station_id is not null then g.location_name end as location_name,
        case when g.station_id is not null and n.station_id is not null then n.location_name end as next_location, o.toc_name
        from in_movement m left join geo g on m.loc_stanox = g.station_id left join geo n on m.next_report_stanox = n.station_id
        left join toc o on m.toc_id = o.toc_operating_code left join current c on m.train_id[3:6] = c.train_signalling_id)
"""


@query(
    "e11_enrich_movements",
    f"""with {ENRICHED} select train_id, train_signalling_id, train_uid, latitude, longitude, location_name, next_location, toc_name,
        cast(actual_timestamp as varchar) as actual_timestamp, cast(ingest_ts as varchar) as ingest_ts, timetable_variation from enriched""",
    ("in_movement", "geo", "schedule", "toc"),
)
def _(t):
    return enriched(t).select(
        "train_id", "train_signalling_id", "train_uid", "latitude", "longitude", "location_name", "next_location",
        "toc_name", "actual_timestamp", "ingest_ts", "timetable_variation",
    )


@query(
    "e12_first_valid_schedule",
    """select train_signalling_id, train_uid from schedule where date '2024-01-10' between schedule_start_date and schedule_end_date
        qualify row_number() over (partition by train_signalling_id order by schedule_start_date desc, schedule_id) = 1""",
    ("schedule",),
)
def _(t):
    return live.current_schedules(t.role("schedule"), ENRICH_DAY)


@query(
    "e12_first_running_schedule",
    """select train_signalling_id, train_uid from schedule where date '2024-01-10' between schedule_start_date and schedule_end_date and wednes_service
        qualify row_number() over (partition by train_signalling_id order by schedule_start_date desc, schedule_id) = 1""",
    ("schedule",),
)
def _(t):
    return live.current_schedules(t.role("schedule"), ENRICH_DAY, use_day_flags=True)


@query(
    "e13_anti_join_append",
    """select o_custkey as c_custkey, 'live' as origin from (select distinct o_custkey from orders)
        union all select c_custkey, 'snapshot' from customer where c_custkey not in (select o_custkey from orders)""",
)
def _(t):
    primary = t.orders.select(C("o_custkey").alias("c_custkey")).distinct().withColumn("origin", F.lit("live"))
    fallback = t.customer.select("c_custkey", F.lit("snapshot").alias("origin"))
    return joins.append_missing(primary, fallback, "c_custkey")


@query(
    "e14_semi_join",
    "select location_id, location_name from geo where location_id in (select location_id from stop)",
    ("geo", "stop"),
)
def _(t):
    return filters.member_of(t.role("geo"), "location_id", t.role("stop"), "location_id").select(
        "location_id", "location_name"
    )


@query(
    "e15_two_key_left_join",
    """with one as (select schedule_id, train_uid, stp_indicator from schedule qualify row_number() over (partition by train_uid order by schedule_id) = 1)
        select s.schedule_id, s.train_uid, o.stp_indicator from schedule s left join one o on s.schedule_id = o.schedule_id and s.train_uid = o.train_uid
        where o.stp_indicator is not null""",
    ("schedule",),
)
def _(t):
    schedules = t.role("schedule").select("schedule_id", "train_uid", "stp_indicator")
    one = dedup.first_k(schedules, ["train_uid"], ["schedule_id"], 1)
    joined = schedules.select("schedule_id", "train_uid").join(one, ["schedule_id", "train_uid"], "left")
    return joined.filter(C("stp_indicator").isNotNull())


# ---- F: aggregates -----------------------------------------------------------------------------


@query(
    "f01_sum_and_count",
    """select l_suppkey, cast(cast(l_shipdate as date) as varchar) as day, cast(sum(cast(l_quantity as bigint)) as bigint) as quantity, count(*) as lines
        from lineitem group by 1, 2""",
)
def _(t):
    return t.lineitem.groupBy("l_suppkey", F.to_date("l_shipdate").alias("day")).agg(
        F.sum(C("l_quantity").cast("bigint")).alias("quantity"), F.count("*").alias("lines")
    )


@query(
    "f02_conditional_counts",
    """select location_id, cast(sum(timetable_variation) as bigint) as sum_delay_mins, count(*) as total_events,
        count(*) filter (event_type = 'DEPARTURE') as total_departures, count(*) filter (event_type = 'ARRIVAL') as total_arrivals,
        count(*) filter (timetable_variation <= 0) as on_time_events, count(*) filter (timetable_variation between 1 and 5) as slight_delay_events,
        count(*) filter (timetable_variation between 6 and 10) as delay_events, count(*) filter (timetable_variation > 10) as major_delay_events
        from movement group by 1""",
    ("movement",),
)
def _(t):
    metrics = aggregates.delay_metrics(C("timetable_variation"), C("event_type"))
    return t.role("movement").groupBy("location_id").agg(*metrics)


@query("f03_global_max", "select cast(max(ts) as varchar) as newest from events")
def _(t):
    return t.events.agg(F.max("ts").alias("newest"))


@query(
    "f04_latest_rows_with_ties",
    """select train_id, cast(actual_timestamp as varchar) as actual_timestamp, location_id, price from movement
        qualify actual_timestamp is not null and rank() over (partition by train_id order by actual_timestamp desc nulls last) = 1""",
    ("movement",),
)
def _(t):
    rows = t.role("movement").select("train_id", "actual_timestamp", "location_id", "price")
    return aggregates.latest_rows(rows, "train_id", "actual_timestamp")


@query(
    "f05_ordered_array",
    """select l_orderkey, cast(0 as bigint) as page, string_agg(l_linenumber || ':' || l_partkey, '|' order by l_linenumber, l_partkey, l_suppkey) as stops
        from lineitem group by 1""",
)
def _(t):
    pages = aggregates.ordered_pages(
        t.lineitem, ["l_orderkey"], ["l_linenumber"], ["l_linenumber", "l_partkey", "l_suppkey"]
    )
    text = F.transform("items", lambda s: F.concat_ws(":", s["l_linenumber"], s["l_partkey"]))
    return pages.select("l_orderkey", "page", F.concat_ws("|", text).alias("stops"))


PAGED = """
    select {key}, (o - 1) // {rows} as page, string_agg({text}, '|' order by o) as items
    from (select *, row_number() over (partition by {key} order by {order}) as o from {table}) group by all"""


@query(
    "f05_ordered_array_in_pages",
    PAGED.format(
        key="l_returnflag", rows=500, text="l_orderkey || ':' || l_linenumber",
        order="l_shipdate, l_orderkey, l_linenumber", table="lineitem",
    ),
)
def _(t):
    """Three keys, each far larger than a page."""
    pages = aggregates.ordered_pages(
        t.lineitem, ["l_returnflag"], ["l_shipdate"], ["l_orderkey", "l_linenumber"], page_rows=500
    )
    text = F.transform("items", lambda s: F.concat_ws(":", s["l_orderkey"], s["l_linenumber"]))
    return pages.select("l_returnflag", "page", F.concat_ws("|", text).alias("items"))


@query(
    "f07_list_per_key_in_pages",
    PAGED.format(
        key="o_orderstatus", rows=300, text="o_orderkey || '/' || o_custkey", order="o_orderkey, o_custkey", table="orders"
    ),
)
def _(t):
    pages = aggregates.ordered_pages(t.orders, ["o_orderstatus"], ["o_orderkey"], ["o_orderkey", "o_custkey"], page_rows=300)
    text = F.transform("items", lambda s: F.concat_ws("/", s["o_orderkey"], s["o_custkey"]))
    return pages.select("o_orderstatus", "page", F.concat_ws("|", text).alias("items"))


WORST = "timetable_variation desc nulls last, train_id, price"


@query(
    "f06_top_k_array",
    f"""select location_id, string_agg(train_id || ':' || coalesce(cast(timetable_variation as varchar), '-'), '|' order by {WORST}) as worst
        from (select * from movement qualify row_number() over (partition by location_id order by {WORST}) <= 5) group by 1""",
    ("movement",),
)
def _(t):
    order = [F.desc_nulls_last("timetable_variation"), "train_id", "price"]
    worst = aggregates.top_k_array(t.role("movement"), ["location_id"], order, ["train_id", "timetable_variation"], 5)
    text = F.transform(
        "items", lambda s: F.concat_ws(":", s["train_id"], F.coalesce(s["timetable_variation"].cast("string"), F.lit("-")))
    )
    return worst.select("location_id", F.concat_ws("|", text).alias("worst"))


@query(
    "f07_list_per_key",
    """select o_custkey, cast(0 as bigint) as page, string_agg(o_orderkey || '/' || o_orderstatus, ',' order by o_orderkey) as orders from orders group by 1""",
)
def _(t):
    pages = aggregates.ordered_pages(t.orders, ["o_custkey"], ["o_orderkey"], ["o_orderkey", "o_orderstatus"])
    text = F.transform("items", lambda s: F.concat_ws("/", s["o_orderkey"], s["o_orderstatus"]))
    return pages.select("o_custkey", "page", F.concat_ws(",", text).alias("orders"))


@query("f08_distinct", "select distinct o_custkey, o_orderstatus, o_orderpriority from orders")
def _(t):
    return t.orders.select("o_custkey", "o_orderstatus", "o_orderpriority").distinct()


def delay_rows(t):
    named = t.role("movement").join(t.role("toc").select("toc_id", "toc_name"), "toc_id", "left")
    return named.select("toc_name", fn.delay_bucket(C("timetable_variation")).alias("delay_category"))


DELAY_ROWS = """
    delay_rows as (select toc_name, case when timetable_variation <= 0 then 'on_time' when timetable_variation <= 5 then 'slight_delay'
        when timetable_variation <= 10 then 'delay' else 'major_delay' end as delay_category from movement m left join toc t on m.toc_id = t.toc_id)
"""
COUNTS = ", ".join(f"count(*) filter (delay_category = '{b}') as {b}" for b in DELAY_BUCKETS)


@query(
    "f09_pivot_count",
    f"with {DELAY_ROWS} select toc_name, {COUNTS} from delay_rows where toc_name is not null group by 1",
    ("movement", "toc"),
)
def _(t):
    return aggregates.category_counts(delay_rows(t), "toc_name", "delay_category")


@query(
    "f10_row_percentages",
    f"""with {DELAY_ROWS}, counts as (select toc_name, count(*) as n, {COUNTS} from delay_rows where toc_name is not null group by 1)
        select toc_name, {", ".join(f"round(100.0 * {b} / n, 6) as {b}" for b in DELAY_BUCKETS)} from counts""",
    ("movement", "toc"),
)
def _(t):
    counts = aggregates.category_counts(delay_rows(t), "toc_name", "delay_category")
    shares = aggregates.row_percentages(counts, "toc_name")
    return shares.withColumns({b: F.round(b, 6) for b in DELAY_BUCKETS})


@query(
    "f11_melt",
    f"""with {DELAY_ROWS}, counts as (select toc_name, {COUNTS} from delay_rows where toc_name is not null group by 1)
        unpivot counts on {", ".join(DELAY_BUCKETS)} into name delay_category value events""",
    ("movement", "toc"),
)
def _(t):
    counts = aggregates.category_counts(delay_rows(t), "toc_name", "delay_category")
    return aggregates.melt(counts, "toc_name", value="events")


@query(
    "f12_leaderboard",
    """select l_suppkey, cast(sum(l_linenumber) as bigint) as l_linenumber, cast(sum(l_partkey) as bigint) as l_partkey, round(avg(l_quantity), 4) as mean_quantity,
        round(avg(l_discount), 4) as mean_discount from lineitem group by 1""",
)
def _(t):
    board = aggregates.leaderboard(
        t.lineitem,
        ["l_suppkey"],
        ["l_linenumber", "l_partkey"],
        {"l_quantity": "mean_quantity", "l_discount": "mean_discount"},
    ).orderBy(F.desc("l_partkey"), "l_suppkey")
    return board.withColumns({c: F.round(c, 4) for c in ("mean_quantity", "mean_discount")})


@query(
    "f13_headline_scalars",
    "select count(*) as total_events, cast(sum(cast(l_quantity as bigint)) as bigint) as total_quantity, round(avg(l_discount), 6) as mean_discount from lineitem",
)
def _(t):
    return t.lineitem.agg(
        F.count("*").alias("total_events"),
        F.sum(C("l_quantity").cast("bigint")).alias("total_quantity"),
        F.round(F.avg("l_discount"), 6).alias("mean_discount"),
    )


@query("f14_distinct_values", "select distinct p_brand from part where p_brand is not null")
def _(t):
    return aggregates.distinct_values(t.part, "p_brand")


@query("f15_centroid", "select round(avg(latitude), 6) as latitude, round(avg(longitude), 6) as longitude from geo", ("geo",))
def _(t):
    return aggregates.centroid(t.role("geo")).select(*[F.round(c, 6).alias(c) for c in ("latitude", "longitude")])


# ---- G: windows ------------------------------------------------------------------------------------


@query(
    "g01_keep_latest",
    """select user_id, event_type, event_id, cast(ts as varchar) as ts from events
        qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1""",
)
def _(t):
    latest = dedup.keep_latest(t.events, ["user_id", "event_type"], by="ts")
    return latest.select("user_id", "event_type", "event_id", "ts")


@query(
    "g02_keep_any",
    """select user_id, event_id, event_type from events qualify row_number() over (partition by user_id, cast(ts as date) order by event_id desc) = 1""",
)
def _(t):
    one = dedup.keep_any(t.events.withColumn("day", F.to_date("ts")), ["user_id", "day"])
    return one.select("user_id", "event_id", "event_type")


BOTH = "(select s_nationkey as station_id, substr(s_name, -2) as code, s_name as name, 'trust' as source from supplier union all select c_nationkey, substr(c_name, -2), c_name, 'schedule' from customer)"


@query(
    "g03_keep_by_priority",
    f"""select station_id, code, name, source from {BOTH}
        qualify row_number() over (partition by station_id, code order by case source when 'trust' then 1 else 2 end, name desc) = 1""",
)
def _(t):
    def named(df, prefix, source):
        return df.select(
            C(f"{prefix}_nationkey").alias("station_id"),
            F.right(C(f"{prefix}_name"), F.lit(2)).alias("code"),
            C(f"{prefix}_name").alias("name"),
            F.lit(source).alias("source"),
        )

    both = named(t.supplier, "s", "trust").unionByName(named(t.customer, "c", "schedule"))
    return dedup.keep_by_priority(both, ["station_id", "code"], "source", ["trust"])


@query(
    "g04_first_and_last",
    """select l_orderkey, arg_min(l_suppkey, o) as first_stop, arg_max(l_suppkey, o) as last_stop
        from (select l_orderkey, l_suppkey, row_number() over (partition by l_orderkey order by l_linenumber, l_suppkey) as o from lineitem) group by 1""",
)
def _(t):
    return dedup.first_and_last(t.lineitem, ["l_orderkey"], ["l_linenumber"], {"l_suppkey": ("first_stop", "last_stop")})


@query(
    "g05_one_per_uid",
    "select o_custkey, o_orderkey, o_orderstatus from orders qualify row_number() over (partition by o_custkey order by o_orderkey) = 1",
)
def _(t):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderstatus")
    return dedup.first_k(rows, ["o_custkey"], ["o_orderkey"], 1)


@query(
    "g06_one_place_per_station",
    """select station_id, tiploc_code, location_id, location_name from location
        qualify row_number() over (partition by station_id order by tiploc_code desc) = 1""",
    ("location",),
)
def _(t):
    return core.one_place_per_station(t.role("location")).select(
        "station_id", "tiploc_code", "location_id", "location_name"
    )


@query(
    "g07_latest_by_two_keys",
    """select user_id, cast(day as varchar) as day, event_id from (select *, cast(ts as date) as day from events)
        qualify row_number() over (partition by user_id order by day desc, event_id desc) = 1""",
)
def _(t):
    rows = t.events.select("user_id", F.to_date("ts").alias("day"), "event_id")
    return dedup.first_k(rows, ["user_id"], [F.desc("day"), F.desc("event_id")], 1)


# ---- I: sorts and top-k --------------------------------------------------------------------------------


@query("i01_global_sort", "select o_orderkey, o_totalprice, cast(o_orderdate as varchar) as o_orderdate from orders")
def _(t):
    rows = t.orders.select("o_orderkey", "o_totalprice", "o_orderdate")
    return rows.orderBy(F.desc("o_orderdate"), F.desc("o_totalprice"), "o_orderkey")


@query(
    "i02_top_k_rows",
    f"""select location_id, train_id, timetable_variation, cast(row_number() over (partition by location_id order by {WORST}) as integer) as place
        from movement qualify place <= 5""",
    ("movement",),
)
def _(t):
    order = [F.desc_nulls_last("timetable_variation"), "train_id", "price"]
    top = aggregates.top_k_rows(t.role("movement"), ["location_id"], order, 5, rank_as="place")
    return top.select("location_id", "train_id", "timetable_variation", "place")


@query(
    "i03_last_k_trail",
    """select user_id, string_agg(event_id, ',' order by ts, event_id) as trail
        from (select * from events qualify row_number() over (partition by user_id order by ts desc, event_id desc) <= 20) group by 1""",
)
def _(t):
    trail = aggregates.last_k_array(t.events, ["user_id"], ["ts", "event_id"], ["event_id"], 20)
    ids = F.transform("items", lambda s: s["event_id"].cast("string"))
    return trail.select("user_id", F.concat_ws(",", ids).alias("trail"))


@query(
    "i04_first_match_in_array",
    """select l_orderkey, arg_min(l_linenumber, o) filter (l_returnflag = 'R') as first_returned, cast(min(o) filter (l_returnflag = 'R') as bigint) as position
        from (select *, row_number() over (partition by l_orderkey order by l_linenumber, l_suppkey, l_partkey, l_returnflag) as o from lineitem) group by 1""",
)
def _(t):
    pages = aggregates.ordered_pages(
        t.lineitem, ["l_orderkey"], ["l_linenumber"], ["l_linenumber", "l_suppkey", "l_partkey", "l_returnflag"]
    )

    def returned(s):
        return s["l_returnflag"] == "R"

    first = arrays.first_match(C("items"), returned)
    at = F.nullif(F.array_position(F.transform("items", returned), True), F.lit(0)) + F.col("page") * aggregates.PAGE_ROWS
    per_page = pages.select("l_orderkey", first["l_linenumber"].alias("number"), at.alias("at"))
    return per_page.groupBy("l_orderkey").agg(
        F.min_by("number", "at").alias("first_returned"), F.min("at").alias("position")
    )


# ---- J: unions -----------------------------------------------------------------------------------------


@query(
    "j01_union_all",
    "select s_nationkey as station_id, s_name as name from supplier union all select c_nationkey, c_name from customer",
)
def _(t):
    left = t.supplier.select(C("s_nationkey").alias("station_id"), C("s_name").alias("name"))
    return left.unionByName(t.customer.select(C("c_nationkey").alias("station_id"), C("c_name").alias("name")))


@query(
    "j02_unknown_member",
    f"select md5(n_name) as toc_key, n_name, n_nationkey from nation union all select {UNKNOWN}, 'Unknown TOC Name', null",
)
def _(t):
    dim = t.nation.select(fn.surrogate_key("n_name").alias("toc_key"), "n_name", "n_nationkey")
    return joins.with_unknown_member(dim, {"toc_key": fn.unknown_key(), "n_name": "Unknown TOC Name"})


@query(
    "j03_live_or_snapshot",
    """select o_custkey as train, 'live' as origin, null::varchar as segment from (select distinct o_custkey from orders where o_orderstatus = 'P')
        union all select c_custkey, null, c_mktsegment from customer where c_custkey not in (select o_custkey from orders where o_orderstatus = 'P')""",
)
def _(t):
    running = t.orders.filter(C("o_orderstatus") == "P")
    live_rows = running.select(C("o_custkey").alias("train")).distinct().withColumn("origin", F.lit("live"))
    return joins.append_missing(
        live_rows, t.customer.select(C("c_custkey").alias("train"), C("c_mktsegment").alias("segment")), "train"
    )


# ---- K: arrays -----------------------------------------------------------------------------------------


@query(
    "k01_unnest",
    f"select location_id, train_id, timetable_variation from movement qualify row_number() over (partition by location_id order by {WORST}) <= 5",
    ("movement",),
)
def _(t):
    order = [F.desc_nulls_last("timetable_variation"), "train_id", "price"]
    worst = aggregates.top_k_array(t.role("movement"), ["location_id"], order, ["train_id", "timetable_variation"], 5)
    return arrays.unnest(worst, "items")


@query(
    "k02_coordinates",
    """select schedule_id, cast(0 as bigint) as page, string_agg(longitude || ' ' || latitude, ',' order by loc_offset, s.location_id) as path
        from stop s join geo g on s.location_id = g.location_id where latitude is not null group by 1""",
    ("stop", "geo"),
)
def _(t):
    places = t.role("geo").filter(C("latitude").isNotNull()).select("location_id", "latitude", "longitude")
    rows = t.role("stop").select("schedule_id", "location_id", "loc_offset").join(places, "location_id")
    pages = aggregates.ordered_pages(rows, ["schedule_id"], ["loc_offset"], ["location_id", "longitude", "latitude"])
    path = F.transform(arrays.coordinates(C("items")), lambda p: F.concat_ws(" ", p["longitude"], p["latitude"]))
    return pages.select("schedule_id", "page", F.concat_ws(",", path).alias("path"))


@query(
    "k03_expand_parallel",
    "select o_orderkey, unnest(['status', 'priority']) as kind, unnest([o_orderstatus, o_orderpriority]) as value from orders",
)
def _(t):
    rows = t.orders.select(
        "o_orderkey",
        F.array(F.lit("status"), F.lit("priority")).alias("kinds"),
        F.array("o_orderstatus", "o_orderpriority").alias("values"),
    )
    return arrays.expand_parallel(rows, ["kinds", "values"], ["kind", "value"])


@query(
    "k04_row_to_json",
    """select event_id, '{"event_id":' || event_id || ',"event_type":"' || event_type || '","props":null}' as json from events""",
)
def _(t):
    row = F.struct("event_id", "event_type", F.lit(None).cast("string").alias("props"))
    return t.events.select("event_id", F.to_json(row, {"ignoreNullFields": "false"}).alias("json"))


@query(
    "k05_append_capped",
    "select event_id, event_type || ',' || user_id || ',new' as kept, 'new' as only from events",
)
def _(t):
    kept = arrays.append_capped(F.array(F.lit("old"), C("event_type"), C("user_id").cast("string")), F.lit("new"), 3)
    only = arrays.append_capped(F.array().cast("array<string>"), F.lit("new"), 3)
    return t.events.select("event_id", F.concat_ws(",", kept).alias("kept"), F.concat_ws(",", only).alias("only"))
