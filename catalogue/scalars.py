"""C-01 to C-34: column functions over whole tables, edge cases made from the row values."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catalogue.models_sql import sk
from catalogue.registry import query
from catalogue.roles import mask
from railmill import functions as fn
from railmill.functions import labels
from railmill.operators.arrays import json_array_rows
from railmill.schemas import MESSAGE_TYPES
from railmill.sources import feeds

C = F.col


def pick(key: str, *values):
    """One of the values per row, chosen by the key: a way to put edge cases in a whole table."""
    out = F.lit(values[-1])
    for i, value in enumerate(values[:-1]):
        out = F.when(C(key) % len(values) == i, F.lit(value)).otherwise(out)
    return out


def pick_sql(key: str, *values) -> str:
    """The SQL twin: the result for each choice, already worked out."""

    def literal(v):
        if v is None:
            return "null"
        return str(v).lower() if isinstance(v, bool) else f"'{v}'" if isinstance(v, str) else str(v)

    whens = " ".join(f"when {i} then {literal(v)}" for i, v in enumerate(values))
    return f"case {key} % {len(values)} {whens} end"


@query(
    "c01_surrogate_key",
    f"select {sk('l_orderkey', 'l_linenumber', 'l_returnflag', 'null', 'l_shipdate')} as row_key, l_extendedprice from lineitem",
)
def _(t):
    key = fn.surrogate_key("l_orderkey", "l_linenumber", "l_returnflag", F.lit(None), "l_shipdate")
    return t.lineitem.select(key.alias("row_key"), "l_extendedprice")


@query("c02_unknown_key", "select n_nationkey, md5('Unknown') as unknown_key from nation")
def _(t):
    return t.nation.select("n_nationkey", fn.unknown_key().alias("unknown_key"))


@query(
    "c03_parse_millis",
    f"""select o_orderkey, cast(case when o_orderkey % 6 = 0 then o_orderdate + interval 123 milliseconds
        else {pick_sql("o_orderkey", None, None, None, "1970-01-01 00:00:00.5", None, "2024-01-01 00:00:00.123")}::timestamp end as varchar) as parsed from orders""",
)
def _(t):
    millis = F.unix_millis(C("o_orderdate").cast("timestamp")) + 123
    text = F.when(C("o_orderkey") % 6 == 0, millis.cast("string")).otherwise(
        pick("o_orderkey", None, "", "abc", " 500 ", "99999999999999999", "1704067200123")
    )
    return t.orders.select("o_orderkey", fn.parse_millis(text).alias("parsed"))


@query(
    "c04_parse_int",
    """select event_id, cast(json_extract(props, '$.k') as bigint) as k,
        case event_id % 4 when 0 then event_id when 1 then 12 else -1 end as lenient from events""",
)
def _(t):
    text = F.when(C("event_id") % 4 == 0, C("event_id").cast("string")).otherwise(
        pick("event_id", None, " 12 ", "abc", "")
    )
    k = fn.parse_int(F.get_json_object("props", "$.k"))
    return t.events.select("event_id", k.alias("k"), fn.parse_int(text, -1).alias("lenient"))


@query("c05_parse_bool", f"select event_id, {pick_sql('event_id', True, False, True, False, False)} as flag from events")
def _(t):
    text = pick("event_id", "TRUE", "false", "true", None, "yes")
    return t.events.select("event_id", fn.parse_bool(text).alias("flag"))


@query(
    "c06_date_midnight",
    """select o_orderkey, case when o_orderkey % 3 = 0 then cast(o_orderdate as varchar) end as midnight from orders""",
)
def _(t):
    text = F.when(C("o_orderkey") % 3 == 0, F.to_date("o_orderdate").cast("string")).otherwise(
        pick("o_orderkey", None, None, "2024-13-45")
    )
    return t.orders.select("o_orderkey", fn.date_midnight(text).alias("midnight"))


@query("c07_signalling_id", "select c_custkey, c_name[3:6] as signal, null::varchar as short from customer")
def _(t):
    return t.customer.select(
        "c_custkey", fn.signalling_id(C("c_name")).alias("signal"), fn.signalling_id(F.left("c_name", F.lit(5))).alias("short")
    )


@query(
    "c08_json_scalar",
    "select event_id, json_extract_string(props, '$.k') as k, null::varchar as missing from events",
)
def _(t):
    return t.events.select(
        "event_id", fn.json_text(C("props"), "$.k").alias("k"), fn.json_text(C("props"), "$.none").alias("missing")
    )


@query("c09_json_subtree", """select event_id, '{"in":[' || user_id || ',2]}' as subtree, '[' || user_id || ',2]' as leaf from events""")
def _(t):
    payload = F.concat(F.lit('{"a":{"in":['), "user_id", F.lit(',2]},"b":1}'))
    return t.events.select(
        "event_id", fn.json_text(payload, "$.a").alias("subtree"), fn.json_text(payload, "$.a.in").alias("leaf")
    )


@query(
    "c10_json_array_rows",
    """select event_id, i as position, case i when 0 then '{"k":' || user_id || '}' when 1 then '"' || event_type || '"' else cast(user_id as varchar) end as element
        from events cross join (values (0), (1), (2)) v(i)""",
)
def _(t):
    array = F.concat(
        F.lit('[{"k":'), "user_id", F.lit('},"\\"'), "event_type", F.lit('\\"",'), "user_id", F.lit("]")
    )
    rows = t.events.select("event_id", array.alias("locations"))
    return json_array_rows(rows, "locations", "position", "element").drop("locations")


@query(
    "c11_safe_cast",
    f"""select event_id, cast(json_extract(props, '$.k') as bigint) as whole, {pick_sql("event_id", 7, None, None, -3)} as number,
        {pick_sql("event_id", None, True, None, None)} as flag from events""",
)
def _(t):
    text = pick("event_id", "7", "true", "x", "-3")
    return t.events.select(
        "event_id",
        fn.safe_cast(fn.json_text(C("props"), "$.k"), "bigint").alias("whole"),
        fn.safe_cast(text, "int").alias("number"),
        fn.safe_cast(F.when(C("event_id") % 4 == 1, text), "boolean").alias("flag"),
    )


@query(
    "c12_strict_cast",
    "select o_orderkey, cast(cast(o_orderdate as date) as varchar) as day, o_custkey as number from orders",
)
def _(t):
    return t.orders.select(
        "o_orderkey",
        fn.strict_cast(F.date_format("o_orderdate", "yyyy-MM-dd"), "date").alias("day"),
        fn.strict_cast(C("o_custkey").cast("string"), "bigint").alias("number"),
    )


@query("c13_iso_to_date", "select o_orderkey, cast(cast(o_orderdate as date) as varchar) as day from orders")
def _(t):
    text = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return t.orders.select("o_orderkey", fn.iso_to_date(text).alias("day"))


@query(
    "c14_blank_to_null",
    "select event_id, case event_id % 3 when 0 then event_type end as clean from events",
)
def _(t):
    text = F.when(C("event_id") % 3 == 0, F.concat(F.lit("  "), "event_type", F.lit(" "))).otherwise(
        pick("event_id", None, "   ", "")
    )
    return t.events.select("event_id", fn.blank_to_null(text).alias("clean"))


@query("c15_code_normalise", "select n_nationkey, upper(n_name) as code, null::varchar as blank from nation")
def _(t):
    padded = F.concat(F.lit(" "), F.lower("n_name"), F.lit("  "))
    return t.nation.select(
        "n_nationkey", fn.code_normalise(padded).alias("code"), fn.code_normalise(F.lit("  ")).alias("blank")
    )


@query("c16_slug_code", "select p_partkey, 'ZZ_' || regexp_replace(lower(p_name || ' (' || p_brand || ')'), '[^a-z0-9]+', '_', 'g') as code from part")
def _(t):
    return t.part.select("p_partkey", fn.slug_code(F.concat("p_name", F.lit(" ("), "p_brand", F.lit(")"))).alias("code"))


@query(
    "c17_hhmm_time",
    f"""select o_orderkey, case o_orderkey % 6 when 0 then lpad(cast(o_orderkey % 24 as varchar), 2, '0') || ':' || lpad(cast(o_orderkey % 60 as varchar), 2, '0') || ':00'
        when 1 then '09:30:00' end as time_of_day from orders""",
)
def _(t):
    hhmm = F.concat(
        F.lpad((C("o_orderkey") % 24).cast("string"), 2, "0"), F.lpad((C("o_orderkey") % 60).cast("string"), 2, "0")
    )
    text = F.when(C("o_orderkey") % 6 == 0, hhmm).otherwise(
        pick("o_orderkey", None, "0930H", "", "2460", None, "93")
    )
    return t.orders.select("o_orderkey", fn.hhmm_time(text).alias("time_of_day"))


@query(
    "c18_allowance_minutes",
    f"select o_orderkey, cast({pick_sql('o_orderkey', 0.5, 1.0, 1.5, 12.0, None, None, None)} as double) as minutes from orders",
)
def _(t):
    code = pick("o_orderkey", "H", "1", "1H", "12", "1X", "", None)
    return t.orders.select("o_orderkey", fn.allowance_minutes(code).alias("minutes"))


@query(
    "c19_day_flags",
    f"select o_orderkey, {', '.join(f'(o_orderkey >> {6 - i}) & 1 = 1 as {n}' for i, n in enumerate(labels.DAY_FLAGS))} from orders",
)
def _(t):
    masked = t.orders.select("o_orderkey", F.expr(mask("o_orderkey")).alias("day_mask"))
    return masked.select("o_orderkey", *fn.day_flags(C("day_mask")))


@query(
    "c20_code_labels",
    f"""select o_orderkey, case o_orderstatus when 'O' then 'STP overlay of permanent schedule' when 'P' then 'Permanent' end as stp,
        case o_orderstatus when 'P' then 'Passenger & Parcels (Permanent - WTT)' when 'F' then 'Freight (Permanent - WTT)' end as status,
        case o_orderstatus when 'P' then 'Push/Pull train' else 'UNKNOWN' end as operating,
        {pick_sql("o_orderkey", "Diesel", "Diesel Electric Multiple Unit", "EMU plus D, E, ED locomotive", None)} as power,
        {pick_sql("o_orderkey", "Reservations compulsory", None, "Reservations recommended")} as reservations,
        {pick_sql("o_orderkey", "Does not run on specified Bank Holiday Mondays", "Does not run on Glasgow Bank Holidays", None)} as holiday,
        {pick_sql("o_orderkey", "Join", "Next", "Divide", None)} as association,
        {pick_sql("o_orderkey", "Standard - the association occurs on the same day", "Over next-midnight - the association occurs the next day",
                  "Over previous-midnight - the association occurs the previous day")} as association_day,
        {pick_sql("o_orderkey", " Originating location - location where the train service starts from", "Intermediate location",
                  "Terminating location - where the service terminates", None)} as place,
        {pick_sql("o_orderkey", "First and Standard", "Standard Only", None)} as class from orders""",
)
def _(t):
    def label(column, mapping, default=None):
        return fn.code_label(column, mapping, default)

    status = C("o_orderstatus")
    return t.orders.select(
        "o_orderkey",
        label(status, labels.STP_INDICATOR).alias("stp"),
        label(status, labels.TRAIN_STATUS).alias("status"),
        label(status, labels.OPERATING_CHARACTERISTIC, "UNKNOWN").alias("operating"),
        label(pick("o_orderkey", "D", "DEM", "EML", "?"), labels.POWER_TYPE).alias("power"),
        label(pick("o_orderkey", "A", None, "R"), labels.RESERVATIONS).alias("reservations"),
        label(pick("o_orderkey", "X", "G", ""), labels.BANK_HOLIDAY).alias("holiday"),
        label(pick("o_orderkey", "JJ", "NP", "VV", "J"), labels.ASSOCIATION_TYPE).alias("association"),
        label(pick("o_orderkey", "S", "N", "P"), labels.ASSOCIATION_DATE).alias("association_day"),
        label(pick("o_orderkey", "LO", "LI", "LT", "XX"), labels.LOCATION_TYPE).alias("place"),
        label(pick("o_orderkey", "B", "S", "b"), labels.TRAIN_CLASS).alias("class"),
    )


@query(
    "c21_delay_bucket",
    """select bucket, count(*) as events from (select case when timetable_variation <= 0 then 'on_time' when timetable_variation <= 5 then 'slight_delay'
        when timetable_variation <= 10 then 'delay' else 'major_delay' end as bucket from movement) group by 1""",
    ("movement",),
)
def _(t):
    bucket = fn.delay_bucket(C("timetable_variation")).alias("bucket")
    return t.role("movement").groupBy(bucket).agg(F.count("*").alias("events"))


@query("c22_sector_code", "select p_partkey, case when p_size % 2 = 0 then 100 else p_size end as code from part")
def _(t):
    text = F.when(C("p_size") % 2 == 0, "?").otherwise(C("p_size").cast("string"))
    return t.part.select("p_partkey", fn.sector_code_number(text).alias("code"))


@query(
    "c23_area_of_station",
    "select s_suppkey, cast(left(cast(s_suppkey as varchar), 2) as integer) as area, cast(left(lpad(cast(s_suppkey as varchar), 5, '0'), 2) as integer) as padded_area from supplier",
)
def _(t):
    return t.supplier.select(
        "s_suppkey",
        fn.area_of_station(C("s_suppkey")).alias("area"),
        fn.area_of_station(C("s_suppkey"), padded=True).alias("padded_area"),
    )


@query(
    "c24_concat_or_null",
    "select n_nationkey, '9100' || n_name as code, case when n_regionkey > 0 then n_name || '-' || n_regionkey end as pair from nation",
)
def _(t):
    region = F.when(C("n_regionkey") > 0, C("n_regionkey"))
    return t.nation.select(
        "n_nationkey",
        fn.concat_or_null(F.lit("9100"), C("n_name")).alias("code"),
        fn.concat_or_null(C("n_name"), F.lit("-"), region).alias("pair"),
    )


@query("c25_text_from", "select c_custkey, substr(c_name, 5) as tail from customer")
def _(t):
    return t.customer.select("c_custkey", fn.text_from(C("c_name"), 5).alias("tail"))


@query(
    "c26_at_time_of_day",
    """select o_orderkey, cast(cast(o_orderdate as date) as varchar) || ' ' || case when o_orderkey % 3 = 0 then '06:00:00' when o_orderkey % 3 = 1 then '07:10:00' else '08:20:00' end as scheduled from orders""",
)
def _(t):
    first = F.when(C("o_orderkey") % 3 == 0, "06:00:00")
    second = F.when(C("o_orderkey") % 3 == 1, "07:10:00")
    return t.orders.select(
        "o_orderkey", fn.at_time_of_day(F.to_date("o_orderdate"), first, second, F.lit("08:20:00")).alias("scheduled")
    )


@query(
    "c27_service_date",
    "select service_date, count(*) as events from (select cast(cast(ts as date) as varchar) as service_date from events) group by 1",
)
def _(t):
    return t.events.groupBy(fn.service_date(C("ts")).alias("service_date")).agg(F.count("*").alias("events"))


@query("c28_weekday_number", "select o_orderkey, cast(dayofweek(o_orderdate) + 1 as integer) as weekday from orders")
def _(t):
    return t.orders.select("o_orderkey", fn.weekday_number(C("o_orderdate")).alias("weekday"))


@query(
    "c29_safe_divide",
    "select l_orderkey, l_linenumber, l_extendedprice, case when l_tax <> 0 then round(l_discount / l_tax, 6) end as ratio from lineitem",
)
def _(t):
    ratio = F.round(F.try_divide("l_discount", "l_tax"), 6)
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", ratio.alias("ratio"))


@query(
    "c30_default_text",
    "select o_orderkey, case when o_orderstatus = 'P' then '--' else o_orderstatus end as status, coalesce(cast(nullif(o_custkey, 7) as varchar), '--') as customer from orders",
)
def _(t):
    status = F.when(C("o_orderstatus") != "P", C("o_orderstatus"))
    customer = F.nullif("o_custkey", F.lit(7)).cast("string")
    return t.orders.select(
        "o_orderkey",
        F.coalesce(status, F.lit(labels.MISSING_TEXT)).alias("status"),
        F.coalesce(customer, F.lit(labels.MISSING_TEXT)).alias("customer"),
    )


@query("c31_all_but", "select * exclude (n_regionkey) from nation")
def _(t):
    return t.nation.drop("n_regionkey")


@query("c32_rename_and_literals", "select n_name as area_name, true as is_active, '2024-02-02 02:00:00' as dbt_updated_at from nation")
def _(t):
    run_ts = dt.datetime(2024, 2, 2, 2, 0)
    return t.nation.select(
        C("n_name").alias("area_name"), F.lit(True).alias("is_active"), F.lit(run_ts).alias("dbt_updated_at")
    )


PLACE = "case when event_id % 4 = 0 then null else user_id end"
FIELDS = {
    "cancellation": ["canx_timestamp", "loc_stanox", "canx_type"],
    "movement": ["actual_timestamp", "loc_stanox", "train_terminated"],
    "activation": ["creation_timestamp", "toc_id", "user_id"],
    "reinstatement": ["reinstatement_timestamp", "loc_stanox", "division_code"],
    "change_origin": ["coo_timestamp", "original_loc_stanox", "reason_code"],
    "change_identity": ["event_timestamp", "revised_train_id"],
    "change_location": ["event_timestamp", "loc_stanox"],
}


@query(
    "c33_typed_events",
    """select event, cast(event_id as varchar) as train_id, cast(date_trunc('millisecond', ts) as varchar) as at,
        case when event in ('change_identity') or event_id % 4 = 0 then null else user_id end as place,
        case event when 'movement' then cast(event_type = 'error' as varchar) when 'change_location' then null else event_type end as detail
        from events cross join (values ('activation'), ('cancellation'), ('movement'), ('reinstatement'), ('change_origin'), ('change_identity'), ('change_location')) v(event)""",
)
def _(t):
    millis = F.unix_millis(C("ts").cast("timestamp")).cast("string")
    place = F.when(C("event_id") % 4 != 0, F.lpad(C("user_id").cast("string"), 8, "0"))
    frames = None
    for code, event in MESSAGE_TYPES.items():
        names = FIELDS[event]
        values = {"train_id": C("event_id").cast("string"), names[0]: millis}
        header = {"msg_type": F.lit(code)}
        if event != "change_identity":
            values[names[1]] = place
        detail = names[-1] if event == "change_identity" or len(names) > 2 else None
        if detail == "user_id":
            header[detail] = C("event_type")
        elif detail == "train_terminated":
            values[detail] = F.when(C("event_type") == "error", "True").otherwise("no")
        elif detail:
            values[detail] = C("event_type")
        message = F.to_json(
            F.struct(
                F.struct(*[v.alias(k) for k, v in header.items()]).alias("header"),
                F.struct(*[v.alias(k) for k, v in values.items()]).alias("body"),
            )
        )
        part = t.events.select(message.alias("value"), C("ts").alias("ingest_ts"))
        frames = part if frames is None else frames.unionByName(part)
    messages = feeds.parse_messages(feeds.split_frames(frames))
    rows = {}
    for event, names in FIELDS.items():
        typed = feeds.typed_fields(event)
        where = F.lit(None).cast("bigint") if event == "change_identity" else typed[names[1]]
        detail = typed[names[-1]].cast("string") if event == "change_identity" or len(names) > 2 else F.lit(None).cast("string")
        rows[event] = F.struct(
            F.lit(event).alias("event"), typed["train_id"].alias("train_id"), typed[names[0]].alias("at"),
            where.alias("place"), detail.alias("detail"),
        )
    return feeds.typed_together(messages, rows)


@query(
    "c34_category_colour",
    """select p_partkey, case when p_type = 'STANDARD' then '[0,100,255]' when p_type = 'ECONOMY' then '[255,140,0]'
        when p_type = 'SMALL' then '[0,180,0]' else '[200,200,200]' end as colour from part""",
)
def _(t):
    name = (
        F.when(C("p_type") == "STANDARD", "long freight TRAIN")
        .when(C("p_type") == "ECONOMY", "unadvertised ORDINARY passenger")
        .when(C("p_type") == "SMALL", "Rail replacement BUS")
        .when(C("p_type") == "PROMO", "unknown kind")
    )
    return t.part.select("p_partkey", fn.category_colour(name).alias("colour"))
