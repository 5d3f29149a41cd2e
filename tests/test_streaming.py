"""Streams equal their batch twins however the input is cut into micro-batches."""

import datetime as dt
import json
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from railmill.plans import live
from railmill.plans.incremental import Run
from railmill.session import shared_dir
from railmill.sources.feeds import parse_messages, split_frames, typed_events
from railmill.streaming import enrich, live_state, route, sinks
from railmill.streaming.table_log import LoggedTable

FRAME = "value string, ingest_ts timestamp"
TS = dt.datetime(2024, 1, 1, 6, 0)


def message(i, code="0003", **body):
    body = {"train_id": f"t{i % 3}", "loc_stanox": str(i), **body}
    return json.dumps({"header": {"msg_type": code}, "body": body})


@pytest.fixture
def frames(spark, tmp_path):
    """Files of frames; a stream reads a given number of them per micro-batch."""
    bodies = [message(i) for i in range(20)] + ['{"bad', message(1, "0004"), "", message(7, "0002")]
    for n in range(6):
        part = tmp_path / "in" / f"{n}.json"
        part.parent.mkdir(exist_ok=True)
        lines = [{"value": b, "ingest_ts": "2024-01-01T06:00:00Z"} for b in bodies[n::6]]
        part.write_text("\n".join(map(json.dumps, lines)))
    path = str(tmp_path / "in")

    def stream(files):
        return spark.readStream.schema(FRAME).option("maxFilesPerTrigger", files).json(path)

    return spark.read.schema(FRAME).json(path), stream


@pytest.mark.parametrize("files", [1, 6])
def test_route_stream_equals_batch(spark, frames, files):
    batch, stream = frames
    out = shared_dir(spark, "out")
    sinks.run_to_end(route.route_stream(stream(files), out, shared_dir(spark, "ck"), available_now=True), 120)
    got = route.read_routed(spark, out)
    assert len({p.folder for p in LoggedTable(spark, out, route.TOPIC_PARTS).state()["parts"]}) == 6 // files
    assert rows(got) == rows(route.routed(batch).select("topic", "value"))
    assert rows(route.read_topic_files(spark, out, "rail_movement_clean").select(F.count("*"))) == [(20,)]


def test_table_stream_equals_batch(spark, frames):
    batch, stream = frames
    out = shared_dir(spark, "out")
    sinks.run_to_end(route.table_stream(stream(2), out, shared_dir(spark, "ck"), available_now=True), 120)
    want = typed_events(parse_messages(split_frames(batch)), "movement")
    got = route.read_table(spark, out, "rail_movement_clean").select(*want.columns)
    assert rows(got) == rows(want)
    assert route.read_table(spark, out, "rail_cancellation_clean").count() == 1


def test_replayed_batch_replaces_itself(spark):
    out = shared_dir(spark, "out")
    for _ in range(2):
        sinks.write_batch(spark.range(5).toDF("k"), 3, out)
    sinks.write_batch(spark.range(2).toDF("k"), 4, out)
    assert spark.read.parquet(out).count() == 7


def positions(spark, n=60):
    return spark.range(n).select(
        F.concat(F.lit("t"), F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 5)).alias("train_id"),
        F.col("id").alias("arrival"),
        F.lit("u").alias("train_uid"),
        F.lit("op").alias("toc_name"),
        F.when(F.col("id") % 7 != 0, F.col("id") * 1.5).alias("latitude"),
        (-F.col("id")).cast("double").alias("longitude"),
        F.format_string("p%s", "id").alias("location_name"),
        F.lit("next").alias("next_location"),
        F.lit("ARRIVAL").alias("planned_event_type"),
        F.timestamp_seconds("id").alias("planned_timestamp"),
        F.col("id").alias("timetable_variation"),
        F.lit("LATE").alias("variation_status"),
        F.lit("ARRIVAL").alias("event_type"),
        (F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 60)).alias("ingest_ts"),
    )


@pytest.mark.parametrize("files,stale", [(1, None), (4, None), (4, 5)])
def test_live_state_equals_batch(spark, files, stale):
    batch = positions(spark)
    path = shared_dir(spark, "pos")
    batch.repartition(4).write.parquet(path)
    stream = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", files).parquet(path)
    out = shared_dir(spark, "out")
    query = live_state.live_state_stream(stream, out, shared_dir(spark, "ck"), stale_minutes=stale, available_now=True)
    sinks.run_to_end(query, 200)
    columns = ["train_id", *live_state.FIELDS, "trail"]
    got = live_state.read_live_states(spark, out)
    want = live.live_states(batch, ["arrival"])
    assert rows(got.select(*columns)) == rows(want.select(*columns))
    trail = {r.train_id: len(r.trail) for r in want.collect()}
    assert trail["t0"] == 20
    newest = {r.train_id: r.last_update for r in got.collect()}
    kept = batch.filter("latitude is not null").groupBy("train_id").agg(F.max("ingest_ts").alias("at"))
    assert newest == {r.train_id: r["at"] for r in kept.collect()}
    as_of = dt.datetime(2024, 1, 1, 1, 3)  # trains seen from 00:58 on
    fresh = live_state.read_live_states(spark, out, as_of)
    assert {r.train_id for r in fresh.collect()} == {t for t, at in newest.items() if at >= as_of - dt.timedelta(minutes=5)}
    hours = {f.split("hour=")[1].split("/")[0] for f in fresh.inputFiles()}
    assert hours and hours <= {"2024-01-01-00", "2024-01-01-01"}
    assert live_state.read_live_states(spark, out, as_of + dt.timedelta(days=1)).count() == 0
    assert spark.conf.get("spark.sql.streaming.noDataMicroBatches.enabled") == "true"
    assert live.live_board(got, "next").columns[0] == "Train ID"


def test_enrich_stream_sees_refreshed_lookups(spark):
    movements = spark.createDataFrame(
        [("xx1A23", 1, 2, 7, 0), ("xx1A23", 1, 3, 8, 1), ("", 1, 2, 7, 2), (None, 1, 2, 7, 3), ("xx9Z", 2, 1, 7, 4)],
        "train_id string, loc_stanox bigint, next_report_stanox bigint, toc_id bigint, n int",
    )
    geo = spark.createDataFrame(
        [(1, "A", 50.0, 0.5), (2, "B", None, None)], "station_id bigint, location_name string, latitude double, longitude double"
    )
    day = dt.date(2024, 1, 10)
    schedules = spark.createDataFrame(
        [("s2", "U2", "1A23", day, day), ("s1", "U1", "1A23", day, day), ("s0", "U0", "1A23", dt.date(2024, 1, 1), day),
         ("s9", "U9", "9Z", dt.date(2023, 1, 1), dt.date(2023, 2, 1))],
        "schedule_id string, train_uid string, train_signalling_id string, schedule_start_date date, schedule_end_date date",
    )
    operators = spark.createDataFrame([(7, "Seven")], "toc_operating_code int, toc_name string")
    path = shared_dir(spark, "mov")
    movements.repartition(2).write.parquet(path)
    calls = []

    def lookups():
        calls.append(1)
        return geo, schedules, operators

    stream = spark.readStream.schema(movements.schema).option("maxFilesPerTrigger", 1).parquet(path)
    out = shared_dir(spark, "out")
    sinks.run_to_end(enrich.enrich_stream(stream, lookups, lambda: day, out, shared_dir(spark, "ck"), available_now=True), 120)
    got = spark.read.parquet(out).select("n", "train_uid", "latitude", "location_name", "next_location", "toc_name")
    assert rows(got) == [
        (0, "U1", 50.0, "A", "B", "Seven"),  # latest start, then first schedule id
        (1, "U1", None, None, None, None),  # next place unknown: no place fields at all
        (2, None, None, None, None, None),
        (3, None, None, None, None, None),
        (4, None, None, "B", "A", "Seven"),
    ]
    assert len(calls) >= 2


def test_a_silent_train_leaves_the_board_by_its_tombstone(spark):
    batch = positions(spark, 12)
    path, out = shared_dir(spark, "pos"), shared_dir(spark, "out")
    batch.coalesce(1).write.parquet(path)
    stream = spark.readStream.schema(batch.schema).parquet(path)
    query = live_state.live_state_stream(stream, out, shared_dir(spark, "ck"), stale_minutes=0.1, interval="1 second")
    trains = {r.train_id for r in batch.filter("latitude is not null").select("train_id").distinct().collect()}
    try:
        deadline, tombs = time.monotonic() + 150, set()
        while tombs != trains and time.monotonic() < deadline and query.isActive:
            time.sleep(2)
            if LoggedTable(spark, out).exists():
                tombs = {r.train_id for r in LoggedTable(spark, out).read().filter("expired").collect()}
    finally:
        query.stop()
    assert tombs == trains and live_state.read_live_states(spark, out).count() == 0
    newest = {r.train_id: r["at"] for r in batch.filter("latitude is not null").groupBy("train_id").agg(F.max("ingest_ts").alias("at")).collect()}
    told = {r.train_id: r.last_update for r in LoggedTable(spark, out).read().filter("expired").collect()}
    assert told == {t: at + dt.timedelta(seconds=6) for t, at in newest.items()}
    at = max(newest.values())
    assert at in {r.last_update for r in live_state.read_live_states(spark, out, at).collect()}  # as it was then
    assert spark.conf.get("spark.sql.streaming.noDataMicroBatches.enabled") == "true"


def test_lookups_are_read_anew_only_with_a_new_version(spark):
    warehouse = shared_dir(spark, "warehouse")

    def publish(n, name):
        run = Run(spark, warehouse, dt.datetime(2024, 1, n, 2))
        places = f"select 1L as station_id, '{name}' as location_name, 50.0D as latitude, 0.5D as longitude union all select 2L, 'B', 51.0D, 0.0D"
        run.store("lookups", "live_places", spark.sql(places))
        run.store("lookups", "live_schedules", spark.sql("select '1A23' as train_signalling_id, 'U1' as train_uid"))
        run.store("core", "dim_toc", spark.sql("select 7 as toc_operating_code, 'Seven' as toc_name"))
        run.finish()

    movements = spark.createDataFrame([("xx1A23", 1, 2, 7)], "train_id string, loc_stanox bigint, next_report_stanox bigint, toc_id bigint")
    lookups = enrich.VersionedLookups(spark, warehouse)
    with pytest.raises(FileNotFoundError):
        lookups()

    def enriched():
        return live.enrich_movements(movements, *lookups())

    def names():
        return [r["location_name"] for r in enriched().collect()]

    publish(1, "A")
    assert names() == ["A"] and lookups() is lookups()
    plan = enriched()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("InMemoryTableScan") == 4  # places in two roles, schedules, operators; no file is opened
    publish(2, "renamed")
    assert names() == ["renamed"]
    publish(3, "again")  # two versions are kept, so held ones can still be read
    assert names() == ["again"]


def test_a_stream_is_not_cut_off_by_a_time_nobody_asked_for():
    class Query:
        id, stopped = "q", False

        def awaitTermination(self, timeout=None):
            return None if timeout is None else False  # still at work after any time

        def stop(self):
            self.stopped = True

    query = Query()
    sinks.run_to_end(query)
    assert query.stopped
    with pytest.raises(TimeoutError):
        sinks.run_to_end(query, 1)


def test_live_train_takes_its_newest_rows_without_frame_operations(monkeypatch):
    class State:
        held = None
        get = lambda self: self.held
        update = lambda self, value: setattr(self, "held", value)

    train = live_state.LiveTrain(2, None, live_state.FIELDS)
    train.state = State()
    nothing = dict.fromkeys(live_state.FIELDS)
    rows = [{**nothing, "arrival": a, "arrived_at": at, "longitude": float(a), "latitude": 1.0, "timetable_variation": v}
            for a, at, v in ((5, "b", 4.0), (3, "a", None), (9, None, None))]
    batch = pd.DataFrame(rows)
    for costly in ("sort_values", "astype", "where", "to_dict"):  # each cost more than all else for a train
        monkeypatch.setattr(pd.DataFrame, costly, None)
    (got,) = train.handleInputRows(("t",), iter([batch]), None)
    assert json.loads(got["trail"][0]) == [{"longitude": 5.0, "latitude": 1.0}, {"longitude": 9.0, "latitude": 1.0}]
    assert got["last_update"][0] == "b" and got["timetable_variation"][0] is None and got["train_id"][0] == "t"
