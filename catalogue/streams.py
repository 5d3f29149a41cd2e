"""A-04, B-05, L-01 to L-06 and M-01 to M-03: streaming jobs and quality checks.

Each stream reads the test tables as a file source until all of it is consumed, writes
below the session's shared folder, and the query reads that output.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogue.registry import query
from catalogue.relational import ENRICHED
from catalogue.scans import messages
from railmill.functions.labels import DEAD_LETTER_TOPIC, TOPICS
from railmill.operators import quality
from railmill.plans import live
from railmill.session import shared_dir
from railmill.streaming import enrich, live_state, route, sinks

C = F.col
ENRICH_DAY = dt.date(2024, 1, 10)


class Stream:
    """The test tables with one of them as a stream; everything else reads as before."""

    def __init__(self, tables, name: str):
        self._tables = tables
        self._name = name
        schema = getattr(tables, name).schema
        frame = tables.spark.readStream.schema(schema).parquet(f"{tables.sf_dir}/{name}.parque[t]")
        setattr(self, name, frame)

    def role(self, name: str):
        from catalogue import roles

        return self._tables.spark.sql(roles.ROLES[name], **{self._name: getattr(self, self._name)})


TOPIC = f"""case event_type when 'click' then 'rail_activation_clean' when 'error' then 'rail_movement_clean'
    when 'purchase' then 'rail_change_identity_clean' else '{DEAD_LETTER_TOPIC}' end"""


def run(query_):
    sinks.run_to_end(query_)


@query("a04_topic_reader", "select event_id, cast(ts as varchar) as ingest_ts from events")
def _(t):
    out = shared_dir(t.spark, "a04")
    stream = messages(Stream(t, "events")).select("event_id", "ingest_ts")
    run(sinks.start(stream, lambda b, n: sinks.write_batch(b, n, out), shared_dir(t.spark, "ck"), available_now=True))
    return t.spark.read.parquet(out).select("event_id", "ingest_ts")


def routed_output(t) -> str:
    out = shared_dir(t.spark, "routed")
    frames = messages(Stream(t, "events"))
    run(route.route_stream(frames, out, shared_dir(t.spark, "ck"), available_now=True))
    return out


@query(
    "l01_route_stream",
    f"""select {TOPIC} as topic, case event_type when 'view' then null else cast(event_id as varchar) end as train_id,
        case event_type when 'view' then 'JSONDecodeError' when 'signup' then 'unknown msg_type=0004' end as reason from events""",
)
def _(t):
    rows = route.read_routed(t.spark, routed_output(t))
    train = F.coalesce(
        F.get_json_object("value", "$.train_id"), F.get_json_object("value", "$.raw.body.train_id")
    )
    return rows.select("topic", train.alias("train_id"), F.get_json_object("value", "$.reason").alias("reason"))


@query(
    "b05_topic_tables",
    """select case event_type when 'click' then 'rail_activation_clean' when 'error' then 'rail_movement_clean' else 'rail_change_identity_clean' end as topic,
        cast(event_id as varchar) as train_id, cast(ts as varchar) as ingest_ts from events where event_type in ('click', 'error', 'purchase')""",
)
def _(t):
    """The tables of all seven topics; four of them get no message here."""
    out = shared_dir(t.spark, "tables")
    frames = messages(Stream(t, "events"))
    run(route.table_stream(frames, out, shared_dir(t.spark, "ck"), available_now=True))
    rows = [
        route.read_table(t.spark, out, topic).select(F.lit(topic).alias("topic"), "train_id", "ingest_ts")
        for topic in TOPICS.values()
    ]
    return reduce(DataFrame.unionByName, rows)


@query(
    "l06_stream_append",
    """select event_type, count(*) as messages from (select case event_type when 'click' then 'rail_activation_clean' when 'error' then 'rail_movement_clean'
        else 'rail_change_identity_clean' end as event_type from events where event_type in ('click', 'error', 'purchase')) group by 1""",
)
def _(t):
    out = shared_dir(t.spark, "tables")
    frames = messages(Stream(t, "events"))
    run(route.table_stream(frames, out, shared_dir(t.spark, "ck"), available_now=True))
    rows = [
        route.read_table(t.spark, out, topic).select(F.lit(topic).alias("event_type"))
        for topic in TOPICS.values()
    ]
    return reduce(DataFrame.unionByName, rows).groupBy("event_type").agg(F.count("*").alias("messages"))


def enriched_output(t):
    """The enriching stream over all movements."""
    out = shared_dir(t.spark, "enriched")

    stored = {
        "live_places": live.one_per_key(t.role("geo"), "station_id"),
        "live_schedules": live.current_schedules(t.role("schedule"), ENRICH_DAY),
        "dim_toc": t.role("toc"),
    }
    paths = {name: shared_dir(t.spark, name) for name in stored}
    for name, df in stored.items():
        df.write.parquet(paths[name])
    movements = Stream(t, "lineitem").role("in_movement")
    lookups = enrich.stored_lookups(t.spark, paths)
    run(enrich.enrich_stream(movements, lookups, None, out, shared_dir(t.spark, "ck"), available_now=True))
    return t.spark.read.parquet(out)


@query(
    "l02_enrich_stream",
    f"""with {ENRICHED} select train_id, train_signalling_id, train_uid, latitude, longitude, location_name, next_location, toc_name,
        cast(actual_timestamp as varchar) as actual_timestamp, cast(ingest_ts as varchar) as ingest_ts, timetable_variation from enriched""",
    ("in_movement", "geo", "schedule", "toc"),
)
def _(t):
    return enriched_output(t).select(
        "train_id", "train_signalling_id", "train_uid", "latitude", "longitude", "location_name", "next_location",
        "toc_name", "actual_timestamp", "ingest_ts", "timetable_variation",
    )


def positions(events):
    """Events as enriched movements: one train per user, arrival by event id."""
    return events.select(
        C("user_id").cast("string").alias("train_id"),
        C("event_id").alias("arrival"),
        F.concat(F.lit("U"), "user_id").alias("train_uid"),
        F.lit("Operator").alias("toc_name"),
        F.when(C("event_type") != "error", C("user_id") + 0.25).alias("latitude"),
        (C("event_id") + 0.5).alias("longitude"),
        C("event_type").alias("location_name"),
        F.concat(F.lit("after "), "event_type").alias("next_location"),
        F.lit("ARRIVAL").alias("planned_event_type"),
        C("ts").cast("timestamp").alias("planned_timestamp"),
        (C("event_id") % 7).alias("timetable_variation"),
        F.lit("LATE").alias("variation_status"),
        C("event_type").alias("event_type"),
        C("ts").cast("timestamp").alias("ingest_ts"),
    )


LIVE = """
    ranked as (select *, row_number() over (partition by user_id order by event_id desc) as r from events where event_type <> 'error'),
    states as (select cast(user_id as varchar) as train_id, 'U' || user_id as train_uid, 'Operator' as toc_name,
        arg_min(event_type, r) as location_name, 'after ' || arg_min(event_type, r) as next_station, cast(arg_min(ts, r) as varchar) as planned_timestamp,
        arg_min(event_id % 7, r) as timetable_variation,
        string_agg((event_id + 0.5) || ' ' || (user_id + 0.25), ',' order by event_id) as trail,
        cast(max(ts) as varchar) as last_update from ranked where r <= 20 group by user_id)
"""


def live_output(t):
    out = shared_dir(t.spark, "live")
    stream = positions(Stream(t, "events").events)
    run(live_state.live_state_stream(stream, out, shared_dir(t.spark, "ck"), available_now=True))
    return live_state.read_live_states(t.spark, out)


def trail_text():
    return F.concat_ws(",", F.transform("trail", lambda p: F.concat_ws(" ", p["longitude"], p["latitude"])))


STATE = ["train_id", "train_uid", "toc_name", "location_name", "next_station", "planned_timestamp", "timetable_variation"]


@query("l03_live_state_stream", f"with {LIVE} select * from states")
def _(t):
    return live_output(t).select(*STATE, trail_text().alias("trail"), "last_update")


@query("l03_live_state_batch", f"with {LIVE} select * exclude (last_update) from states")
def _(t):
    states = live.live_states(positions(t.events), ["arrival"])
    return states.select(*STATE, trail_text().alias("trail"))


@query(
    "l04_micro_batches",
    "select count(*) as messages, count(*) filter (event_type = 'view') as undecodable from events",
)
def _(t):
    rows = route.read_routed(t.spark, routed_output(t))
    bad = F.get_json_object("value", "$.reason") == "JSONDecodeError"
    return rows.agg(F.count("*").alias("messages"), F.count_if(bad).alias("undecodable"))


@query(
    "l05_live_board",
    f"""with {LIVE} select train_id as "Train ID", train_uid as "Train UID", toc_name as "Operator", location_name as "Current Station",
        next_station as "Next Station", 'ARRIVAL' as "Planned Type", planned_timestamp as "Planned Time", timetable_variation as "Variation", 'LATE' as "Status", last_update as "Last Update"
        from states where location_name = 'click' or next_station = 'click'""",
)
def _(t):
    return live.live_board(live_output(t), "click")


MOMENTS = [dt.datetime(2024, 1, 12), dt.datetime(2024, 1, 22), dt.datetime(2024, 2, 1, 12)]
WINDOW = 3 * 24 * 60
PARTS = 3


def _moments_sql() -> str:
    """States after each of three micro-batches, as far as it touched a train, seen at three moments."""
    last = f"cast(floor((select max(event_id) + 1 from events) * {{}} / {PARTS}) as bigint)"
    written = " union all ".join(
        f"""select {n} as b, user_id, arg_min(event_type, r) as location_name, max(ts) as last_update, count(*) as points
            from (select *, row_number() over (partition by user_id order by event_id desc) as r from events
                  where event_type <> 'error' and event_id < {last.format(n + 1)})
            where r <= 20 group by user_id having max(event_id) >= {last.format(n)}"""
        for n in range(PARTS)
    )
    moments = " union all ".join(f"select timestamp '{m}' as as_of" for m in MOMENTS)
    return f"""with written as ({written}), moments as ({moments})
        select cast(as_of as varchar) as as_of, cast(user_id as varchar) as train_id, location_name, points, cast(last_update as varchar) as last_update
        from written join moments on last_update between as_of - interval '{WINDOW}' minute and as_of
        qualify row_number() over (partition by as_of, user_id order by b desc) = 1"""


@query("l05_live_board_moments", _moments_sql())
def _(t):
    """The board at a past, a present and a late moment, from a stream of three micro-batches."""
    source, out = shared_dir(t.spark, "parts"), shared_dir(t.spark, "live")
    last = t.events.agg(F.max("event_id") + 1).first()[0]
    for n in range(PARTS):
        part = t.events.filter((C("event_id") >= last * n // PARTS) & (C("event_id") < last * (n + 1) // PARTS))
        part.coalesce(1).write.parquet(f"{source}/{n}")
    stream = t.spark.readStream.schema(t.events.schema).option("maxFilesPerTrigger", 1).parquet(f"{source}/*")
    run(live_state.live_state_stream(positions(stream), out, shared_dir(t.spark, "ck"), available_now=True))
    boards = [
        live_state.read_live_states(t.spark, out, m, WINDOW).select(
            F.lit(str(m)).alias("as_of"), "train_id", "location_name", F.size("trail").cast("bigint").alias("points"), "last_update"
        )
        for m in MOMENTS
    ]
    return reduce(DataFrame.unionByName, boards)


# ---- data quality ---------------------------------------------------------------------------------------


@query(
    "m01_null_counts",
    """select 'movement' as table_name, column_name, null_rows, case when null_rows = 0 then 'pass' else 'fail' end as status from (
        select 'train_id' as column_name, count(*) - count(train_id) as null_rows from movement
        union all select 'actual_timestamp', count(*) - count(actual_timestamp) from movement
        union all select 'timetable_variation', count(*) - count(timetable_variation) from movement)""",
    ("movement",),
)
def _(t):
    return quality.null_counts(t.role("movement"), "movement", ["train_id", "actual_timestamp", "timetable_variation"])


@query(
    "m02_freshness",
    """select 'events' as table_name, cast(max(ts) as varchar) as newest, 'warn' as status from events""",
)
def _(t):
    return quality.freshness(t.events, "events", dt.datetime(2024, 1, 31, 12, 0), column="ts")


@query(
    "m03_duplicate_keys",
    """select 'lineitem' as table_name, count(*) as repeated_keys, cast(sum(n - 1) as bigint) as extra_rows
        from (select l_orderkey, l_linenumber, count(*) as n from lineitem group by 1, 2 having n > 1)""",
)
def _(t):
    return quality.duplicate_keys(t.lineitem, "lineitem", ["l_orderkey", "l_linenumber"])
