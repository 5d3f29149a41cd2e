"""A-01 to A-12 and B-01 to B-12: sources and sinks over the test tables.

Sinks write below the session's shared folder and the query reads the result back.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catalogue.registry import query
from railmill.functions.labels import DEAD_LETTER_TOPIC
from railmill.operators.dedup import keep_latest
from railmill.operators.filters import on_run_date
from railmill.operators.joins import upsert
from railmill.schemas import AREA_FIELDS, CORPUS_FIELDS, BERTH_STEP_FIELDS
from railmill.session import shared_dir
from railmill.sources import feeds, files, tables

RUN_TS = dt.datetime(2024, 2, 1, 2, 0, 0)


def event_lines(t):
    """Events as tagged JSON lines, with blank, malformed and non-object lines among them."""
    bad = (
        F.when(F.col("event_id") % 50 == 0, "   ")
        .when(F.col("event_id") % 50 == 1, '{"broken": ')
        .when(F.col("event_id") % 50 == 2, '{"scalar": 5}')
    )
    line = F.concat(F.lit(' {"'), F.col("event_type"), F.lit('": '), F.col("props"), F.lit(', "later": {}}'))
    return t.events.select(F.coalesce(bad, line).alias("value"), "event_id")


@query(
    "a01_tagged_dump",
    """select case when event_id % 50 = 2 then 'scalar' else event_type end as record_type,
        case when event_id % 50 <> 2 then cast(json_extract(props, '$.k') as integer) end as k, event_id % 50 <> 2 as has_payload,
        '2024-02-01 02:00:00' as ingest_ts from events where event_id % 50 not in (0, 1)""",
)
def _(t):
    path = shared_dir(t.spark, "dump")
    event_lines(t).select("value").write.option("compression", "gzip").text(path)
    rows = files.read_tagged_dump(t.spark, path, RUN_TS)
    return rows.select(
        "record_type",
        F.get_json_object("payload", "$.k").cast("int").alias("k"),
        F.col("payload").isNotNull().alias("has_payload"),
        "ingest_ts",
    )


@query(
    "a02_split_frames",
    """select event_id, unnest(case when event_id % 3 = 0 then [event_type, 'second'] else [event_type] end) as record
        from events where event_id % 7 <> 0""",
)
def _(t):
    one = F.to_json(F.struct(F.col("event_type").alias("r")))
    pair = F.concat(F.lit(" ["), one, F.lit(', {"r":"second"}]'))
    body = F.when(F.col("event_id") % 7 == 0, " ").when(F.col("event_id") % 3 == 0, pair).otherwise(one)
    records = feeds.split_frames(t.events.select("event_id", body.alias("value")))
    return records.select("event_id", F.get_json_object("value", "$.r").alias("record"))


@query(
    "a03_split_berth_frames",
    """select event_id, event_type, lpad(cast(user_id as varchar), 4, '0') as from_berth, cast(date_trunc('millisecond', ts) as varchar) as event_ts
        from events where event_type in ('click', 'error')""",
)
def _(t):
    entry = F.to_json(
        F.struct(
            F.col("event_type").alias("msg_type"),
            F.lpad(F.col("user_id").cast("string"), 4, "0").alias("from"),
            F.unix_millis(F.col("ts").cast("timestamp")).cast("string").alias("time"),
        )
    )
    tag = F.when(F.col("event_type").isin("click", "error"), "CA_MSG").otherwise("SF_MSG")
    frame = F.concat(F.lit('[{"'), tag, F.lit('":'), entry, F.lit("}]"))
    frames = t.events.select("event_id", F.col("ts").alias("ingest_ts"), frame.alias("value"))
    records = feeds.split_berth_frames(frames)
    typed = feeds.typed_berth_steps(records.withColumn("ingest_ts", F.col("event_id").cast("timestamp")))
    return typed.select(
        F.unix_seconds("ingest_ts").alias("event_id"), F.col("msg_type").alias("event_type"), "from_berth", "event_ts"
    )


@query(
    "a05_typed_seed",
    """select ' ' || n_name as company, ' B' || n_nationkey as business_code, cast(n_regionkey as varchar) as sector_code, 'x,"y"' as atoc_code from nation""",
)
def _(t):
    path = shared_dir(t.spark, "seed")
    rows = t.nation.select(
        F.concat(F.lit(" "), "n_name").alias("company"),
        F.concat(F.lit(" B"), F.col("n_nationkey")).alias("business_code"),
        F.col("n_regionkey").cast("string").alias("sector_code"),
        F.lit('x,"y"').alias("atoc_code"),
    )
    rows.write.option("ignoreLeadingWhiteSpace", "false").csv(path, header=True, escape='"')
    return files.read_seed(t.spark, path, "toc")


@query(
    "a06_reference_places_extract",
    """select cast(s_suppkey * 10 as varchar) as nlc, cast(s_suppkey as varchar) as stanox, 'TIP' || s_suppkey as tiploc, null::varchar as three_alpha,
        cast(s_nationkey as varchar) as uic, s_name as nlc_desc, left(s_name, 16) as nlc_desc_16 from supplier""",
)
def _(t):
    values = {
        "NLC": F.col("s_suppkey") * 10,
        "STANOX": F.col("s_suppkey"),
        "TIPLOC": F.concat(F.lit("TIP"), F.col("s_suppkey")),
        "UIC": F.col("s_nationkey"),
        "NLCDESC": F.col("s_name"),
        "NLCDESC16": F.left("s_name", F.lit(16)),
    }
    documents = t.supplier.select(
        F.to_json(F.struct(F.array(F.struct(*[v.cast("string").alias(n) for n, v in values.items()])).alias("TIPLOCDATA"))).alias("value")
    )
    path = shared_dir(t.spark, "corpus")
    documents.write.text(path)
    schema = "TIPLOCDATA array<struct<{}>>".format(", ".join(f"`{n}`: string" for n in CORPUS_FIELDS))
    return files.flatten_extract(t.spark.read.schema(schema).json(path), "TIPLOCDATA", CORPUS_FIELDS)


@query(
    "a07_berth_steps_extract",
    """select p_brand as step_type, lpad(cast(p_partkey % 50 as varchar), 4, '0') as from_berth, lpad(cast(p_size as varchar), 4, '0') as to_berth,
        cast(p_partkey as varchar) as stanox, 'A' as event, null::varchar as platform, null::varchar as to_line, '0' as berth_offset,
        null::varchar as route, null::varchar as from_line, p_type as td, null::varchar as comment, p_name as stanme from part""",
)
def _(t):
    values = {
        "STEPTYPE": F.col("p_brand"),
        "FROMBERTH": F.lpad((F.col("p_partkey") % 50).cast("string"), 4, "0"),
        "TOBERTH": F.lpad(F.col("p_size").cast("string"), 4, "0"),
        "STANOX": F.col("p_partkey").cast("string"),
        "EVENT": F.lit("A"),
        "BERTHOFFSET": F.lit("0"),
        "TD": F.col("p_type"),
        "STANME": F.col("p_name"),
    }
    documents = t.part.select(
        F.to_json(F.struct(F.array(F.struct(*[v.alias(n) for n, v in values.items()])).alias("BERTHDATA"))).alias("value")
    )
    path = shared_dir(t.spark, "berths")
    documents.write.text(path)
    schema = "BERTHDATA array<struct<{}>>".format(", ".join(f"`{n}`: string" for n in BERTH_STEP_FIELDS))
    return files.flatten_extract(t.spark.read.schema(schema).json(path), "BERTHDATA", BERTH_STEP_FIELDS)


@query(
    "a08_area_normalise",
    """select 'A' || p_partkey as area_id, p_name as name, p_size % 2 = 0 as sig, p_size % 3 = 0 as rte, false as lat, p_size % 5 = 0 as trk,
        false as pts, false as lxg, p_type as commissioning from part where p_partkey % 9 <> 0""",
)
def _(t):
    def tick(condition):
        return F.when(condition, "✔").otherwise("?")

    size = F.col("p_size")
    cells = [
        F.concat(F.lit("A"), F.col("p_partkey")), F.col("p_name"), tick(size % 2 == 0), tick(size % 3 == 0), F.lit(""),
        tick(size % 5 == 0), F.lit("x"), F.lit(None).cast("string"), F.col("p_type"),
    ]
    short = F.array(*cells[: len(AREA_FIELDS) - 1])
    rows = t.part.select(F.when(F.col("p_partkey") % 9 == 0, short).otherwise(F.array(*cells)).alias("cells"))
    return files.normalise_areas(rows)


@query(
    "a09_station_area_normalise",
    "select left(p_name, 2) as stanox_code, p_brand as br_region, p_type as locations from part",
)
def _(t):
    raw = t.part.select(
        F.col("p_name").alias("STANOX Code"), F.col("p_brand").alias("BR Region"), F.col("p_type").alias("Main Locations")
    )
    return files.normalise_station_areas(raw)


@query("a10_column_projection", "select p_partkey, p_type from part")
def _(t):
    return files.project_columns(t.part, ("p_partkey", "p_type"))


@query("a11_named_table", "select r_regionkey, r_name from region")
def _(t):
    tables.materialise(t.region, "railmill_region", as_table=False)
    return files.named_table(t.spark, "railmill_region")


@query("a12_parquet_glob", "select o_orderkey, o_orderstatus from orders")
def _(t):
    found = files.read_parquet_set(t.spark, f"{t.sf_dir}/order*.parquet")
    return found.select("o_orderkey", "o_orderstatus")


# ---- sinks ------------------------------------------------------------------------------------------


def stamped(t):
    return t.events.withColumn("ingest_ts", F.col("ts").cast("timestamp"))


@query("b01_parquet_writer", "select event_id, event_type from events")
def _(t):
    path = shared_dir(t.spark, "b01")
    tables.write_parquet(t.events, path)
    return t.spark.read.parquet(path).select("event_id", "event_type")


@query(
    "b02_append_days",
    """select event_id, event_type, cast(cast(ts as date) as varchar) as ingest_date, 'kept' as status from events where event_id % 10 <> 0
        union all select event_id, null, null, 'rejected' from events where event_id % 10 = 0""",
)
def _(t):
    path = shared_dir(t.spark, "b02")
    rows = stamped(t).withColumn("event_type", F.when(F.col("event_id") % 10 != 0, F.col("event_type")))
    rejected = tables.append_days(rows, path, ["event_id", "event_type"])
    kept = t.spark.read.parquet(path).select("event_id", "event_type", "ingest_date", F.lit("kept").alias("status"))
    lost = rejected.select(
        "event_id", "event_type", F.lit(None).cast("date").alias("ingest_date"), F.lit("rejected").alias("status")
    )
    return kept.unionByName(lost)


KINDS = {"click": "0001", "error": "0003", "purchase": "0007", "signup": "0004"}


def messages(t):
    """Events as feed messages: three routed kinds, one unknown, views as broken JSON."""
    kind = F.create_map(*[F.lit(x) for pair in KINDS.items() for x in pair])
    body = F.struct(F.col("event_id").cast("string").alias("train_id"))
    header = F.struct(F.try_element_at(kind, F.col("event_type")).alias("msg_type"))
    good = F.to_json(F.struct(header.alias("header"), body.alias("body")))
    value = F.when(F.col("event_type") == "view", F.concat(F.lit('{"header":'), F.col("event_id"))).otherwise(good)
    return t.events.select("event_id", F.col("ts").alias("ingest_ts"), value.alias("value"))


@query(
    "b03_route_fan_out",
    f"""select case event_type when 'click' then 'rail_activation_clean' when 'error' then 'rail_movement_clean'
        when 'purchase' then 'rail_change_identity_clean' else '{DEAD_LETTER_TOPIC}' end as topic, count(*) as messages from events group by 1""",
)
def _(t):
    path = shared_dir(t.spark, "b03")
    routed = feeds.route_messages(feeds.parse_messages(feeds.split_frames(messages(t))))
    routed.write.partitionBy("topic").parquet(path)
    return t.spark.read.parquet(path).groupBy("topic").agg(F.count("*").alias("messages"))


@query(
    "b04_dead_letters",
    """select case event_type when 'view' then 'JSONDecodeError' else 'unknown msg_type=0004' end as reason,
        case event_type when 'view' then '{"header":' || event_id
             else '{"body":{"train_id":"' || event_id || '"},"header":{"msg_type":"0004"}}' end as raw
        from events where event_type in ('view', 'signup')""",
)
def _(t):
    routed = feeds.route_messages(feeds.parse_messages(feeds.split_frames(messages(t))))
    letters = routed.filter(F.col("topic") == DEAD_LETTER_TOPIC)
    return letters.select(
        F.get_json_object("value", "$.reason").alias("reason"), F.get_json_object("value", "$.raw").alias("raw")
    )


@query(
    "b06_upsert",
    """select o_orderkey, case when o_orderdate >= timestamp '1998-01-01' then 'updated' else o_orderstatus end as o_orderstatus from orders""",
)
def _(t):
    target = t.orders.filter(F.col("o_orderdate") < "2000-01-01").select("o_orderkey", "o_orderstatus")
    changed = t.orders.filter(F.col("o_orderdate") >= "1998-01-01")
    updates = changed.select("o_orderkey", F.lit("updated").alias("o_orderstatus"))
    return upsert(target, updates, ["o_orderkey"])


@query(
    "b06_merge_days",
    """select user_id, event_id, event_type, cast(cast(ts as date) as varchar) as ingest_date from events
        qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1""",
)
def _(t):
    path = shared_dir(t.spark, "b06")
    keys = ["user_id", "event_type"]
    rows = stamped(t).select("user_id", "event_id", "event_type", "ingest_ts")
    half = dt.datetime(2024, 1, 15)
    for part in (rows.filter(F.col("ingest_ts") < F.lit(half)), rows.filter(F.col("ingest_ts") >= F.lit(half))):
        tables.merge_days(t.spark, path, keep_latest(part, keys), keys)
    return t.spark.read.parquet(path).select(*keys, "event_id", "ingest_date")


@query(
    "b07_overwrite_days",
    """select event_id, case when cast(ts as date) = date '2024-01-10' then 'rewritten' else event_type end as event_type,
        cast(cast(ts as date) as varchar) as ingest_date from events where cast(ts as date) <> date '2024-01-10' or event_type = 'click'""",
)
def _(t):
    path = shared_dir(t.spark, "b07")
    rows = stamped(t).select("event_id", "event_type", "ingest_ts")
    tables.overwrite_days(rows, path)
    day = rows.filter((F.to_date("ingest_ts") == "2024-01-10") & (F.col("event_type") == "click"))
    for _ in range(2):  # a rerun changes nothing
        tables.overwrite_days(day.withColumn("event_type", F.lit("rewritten")), path)
    return t.spark.read.parquet(path).select("event_id", "event_type", "ingest_date")


@query(
    "b08_run_date_scan",
    "select event_id, cast(cast(ts as date) as varchar) as ingest_date from events where cast(ts as date) between date '2024-01-09' and date '2024-01-10'",
)
def _(t):
    rows = tables.with_ingest_date(t.events, "ts").select("event_id", "ingest_date")
    return on_run_date(rows, dt.date(2024, 1, 10), lookback_days=1)


@query("b09_clustered_write", "select o_custkey, o_orderkey from orders")
def _(t):
    path = shared_dir(t.spark, "b09")
    tables.clustered(t.orders.select("o_custkey", "o_orderkey"), ["o_custkey", "o_orderkey"]).write.parquet(path)
    return t.spark.read.parquet(path)


@query("b10_materialise", "select n_nationkey, n_name from nation")
def _(t):
    return tables.materialise(t.nation.select("n_nationkey", "n_name"), "railmill_nation", as_table=False)


@query(
    "b11_geo_snapshot",
    """select 'geo:' || station_id as key, '{"location_name":"' || location_name || '","lat":' || coalesce(cast(latitude as varchar), 'null') || ',"lon":' || longitude || '}' as value from geo""",
    ("geo",),
)
def _(t):
    return tables.geo_snapshot(t.role("geo"))


@query(
    "b12_schedule_snapshot",
    """select 'schedule:' || train_uid as key, cast(0 as bigint) as page, '[' || string_agg('{"schedule_id":"' || schedule_id || '","stp_indicator":"' || stp_indicator || '","start_date":"' || schedule_start_date
        || '","end_date":"' || schedule_end_date || '","mon":' || mon_service || ',"tue":' || tue_service || ',"wed":' || wednes_service || ',"thu":' || thrus_service
        || ',"fri":' || fri_service || ',"sat":' || sat_service || ',"sun":' || sun_service || '}', ',' order by schedule_start_date, schedule_id) || ']' as value
        from schedule group by train_uid""",
    ("schedule",),
)
def _(t):
    return tables.schedule_snapshot(t.role("schedule"))
